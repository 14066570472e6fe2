"""Given tables served as the outside services serve theirs: by pages of a running number, and by searches of days with a cap.

They stand in for a transport: what a source asks is answered from Parquet files, on the executor that asks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import date

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.paged import Window
from ..storage import stored


#: Rows that a lookup decodes at once.
BATCH = 1 << 16


def as_rows(batch: pa.RecordBatch) -> list[tuple]:
    return list(zip(*(c.to_pylist() for c in batch.columns), strict=True))


class Served:
    """``df`` stored in order of ``key``, for lookups of ranges of it."""

    def __init__(self, df: DataFrame, key: str, name: str):
        self.key, self.columns = key, df.columns
        self.path = stored(df.repartitionByRange(key).sortWithinPartitions(key), name)._scratch

    def batches(self, low: object, high: object) -> Iterator[pa.RecordBatch]:
        """Rows with low <= key <= high, a batch in memory at a time."""
        system, where = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", self.path))
        field = pc.field(self.key)
        found = ds.dataset(where, filesystem=system, format="parquet")
        yield from found.to_batches(columns=self.columns, filter=(field >= low) & (field <= high), batch_size=BATCH, batch_readahead=1, fragment_readahead=1, use_threads=False)

    def between(self, low: object, high: object) -> list[tuple]:
        """Rows with low <= key <= high, in order."""
        return sorted(row for batch in self.batches(low, high) for row in as_rows(batch))


class Numbered(Served):
    """Pages by a running number from 0."""

    def __init__(self, df: DataFrame, key: str, name: str):
        super().__init__(df, key, name)
        self.rows = 1 + df.agg(F.coalesce(F.max(key), F.lit(-1))).first()[0]

    def total(self, since: object) -> int:
        return self.rows

    def fetch(self, offset: int, size: int, since: object) -> list[tuple]:
        return self.between(offset, offset + size - 1)


class Dated(Served):
    """Searches by days that give the first ``cap`` hits, ordered by the first column, and say whether there are more."""

    def __init__(self, df: DataFrame, key: str, name: str, cap: int):
        super().__init__(df, key, name)
        self.cap = cap

    def search(self, window: Window) -> tuple[list[tuple], bool]:
        """Holds a batch and one row more than ``cap``, however many rows the window has."""
        first: list[tuple] = []
        for batch in self.batches(*window):
            if len(first) > self.cap:
                batch = batch.filter(pc.less_equal(batch.column(0), pa.scalar(first[-1][0], batch.schema.field(0).type)))
            elif batch.num_rows > self.cap:
                # Equals of the last one that counts stay, so that the other columns decide between them.
                least = pc.array_sort_indices(batch.column(0))[: self.cap + 1]
                batch = batch.filter(pc.less_equal(batch.column(0), batch.column(0)[least[-1].as_py()]))
            first = sorted(first + as_rows(batch))[: self.cap + 1]
        return first[: self.cap], len(first) > self.cap


def days_of(df: DataFrame, column: str) -> Window:
    low, high = df.selectExpr(f"min({column})", f"max({column})").first()
    return low or date(1970, 1, 1), high or date(1970, 1, 1)
