"""A search that caps its hits, as a source that narrows its windows: capped windows are halved for the next round.

A round is one scan: its partitions are lists of windows, at most ``concurrency`` of them, read by executors.
Every window gives a row that says whether it was capped, and its hits unless it will be halved. Rounds are stored, so a lost
executor repeats no search of an earlier one, and there are as many as a window of days can be halved.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..operators.upsert import latest
from ..storage import stored
from .paged import WAIT_S, Window, bisect, with_retries
from .portal import status_class

CONCURRENCY = 2
#: What precedes a hit's own columns. A window's own row has a null place, a hit its place among the window's.
HEAD = "since date, until date, capped boolean, place int"

#: (hits in the columns' order, whether there were more than the search gives) of a window.
Search = Callable[[Window], tuple[list[tuple], bool]]


class Windows(InputPartition):
    def __init__(self, windows: list[Window]):
        super().__init__(windows)
        self.windows = windows


class WindowReader(DataSourceReader):
    def __init__(self, search: Search, width: int, wait: float, windows: list[Window], concurrency: int):
        self.search, self.width, self.wait, self.windows, self.concurrency = search, width, wait, windows, concurrency

    def partitions(self) -> list[Windows]:
        return [Windows(own) for k in range(self.concurrency) if (own := self.windows[k :: self.concurrency])]

    def read(self, partition: Windows) -> Iterator[tuple]:
        for since, until in partition.windows:
            ((hits, capped),) = with_retries(lambda w=(since, until): [self.search(w)], wait=self.wait)
            yield (since, until, capped, None, *[None] * self.width)
            if not capped or since == until:
                for place, hit in enumerate(hits):
                    yield (since, until, capped, place, *hit)


def window_source(name: str, columns: str, search: Search, *, wait: float = WAIT_S) -> type[DataSource]:
    """A source to register with ``spark.dataSource.register``. Options: ``windows``, a JSON list of pairs of days, and ``concurrency``."""
    width = len(StructType.fromDDL(columns).fields)

    class Searched(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return f"{HEAD}, {columns}"

        def reader(self, schema: StructType) -> WindowReader:
            windows = [(date.fromisoformat(a), date.fromisoformat(b)) for a, b in json.loads(self.options["windows"])]
            return WindowReader(search, width, wait, windows, int(self.options.get("concurrency", CONCURRENCY)))

    return Searched


@dataclass
class Found:
    """``hits``: one row a key, those of later windows first; ``flagged``: single days that stayed capped; ``searched``: every window with its hits."""

    hits: DataFrame
    flagged: DataFrame
    searched: DataFrame
    rounds: int


def harvest(spark: SparkSession, source: str, window: Window, key: list[str], *, concurrency: int = CONCURRENCY) -> Found:
    """All hits of the registered ``source`` within ``window``. The driver sees a row for each capped window, never a hit."""
    todo, rounds = [window], []
    while todo:
        asked = json.dumps([[a.isoformat(), b.isoformat()] for a, b in todo])
        rounds.append(stored(spark.read.format(source).option("windows", asked).option("concurrency", concurrency).load(), "windows"))
        capped = rounds[-1].where("place IS NULL AND capped AND since < until").select("since", "until").collect()
        todo = [half for r in capped for half in bisect((r["since"], r["until"])) or ()]
    rows = rounds[0]
    for more in rounds[1:]:
        rows = rows.union(more)
    head = [n.split()[0] for n in HEAD.split(", ")]
    hits = latest(rows.where("place IS NOT NULL"), key, [F.desc("since"), F.desc("place")]).drop(*head)
    flagged = rows.where("place IS NULL AND capped AND since = until").select(F.col("since").alias("day"))
    searched = rows.groupBy("since", "until").agg(F.bool_or("capped").alias("capped"), F.count("place").alias("hits"))
    return Found(hits, flagged, searched, len(rounds))


#: Columns that ``fetched`` adds. ``kind`` is ok, transient or permanent; a page is null unless it is ok.
FETCHED = "html string, kind string, error string, latency_ms double"


def fetched(hits: DataFrame, url: str, get: Callable[[str], tuple[int, str]], *, concurrency: int = CONCURRENCY, attempts: int = 4, wait: float = 0.75) -> DataFrame:
    """``hits`` with the page of each one's ``url`` column: at most ``concurrency`` requests at once, failed ones kept as rows.

    ``get`` gives (status, body). Transient failures are tried again with doubling waits. Rows without a url are left out.
    """
    rows = hits.where(F.col(url).isNotNull())
    names = rows.columns

    def one(address: str) -> tuple[str | None, str, str | None, float]:
        for attempt in range(1, attempts + 1):
            began = time.monotonic()
            try:
                status, body = get(address)
            except OSError as e:
                status, body = 599, str(e)
            took, kind = 1000 * (time.monotonic() - began), status_class(status)
            if kind == "ok":
                return body, kind, None, took
            if kind == "permanent" or attempt == attempts:
                return None, kind, f"status {status} after {attempt} attempts", took
            time.sleep(wait * 2 ** (attempt - 1))
        raise AssertionError

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [one(a) for a in batch.column(names.index(url)).to_pylist()]
            columns = zip(*made, strict=True) if made else [[]] * 4
            kinds = [pa.string(), pa.string(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]], names=[*names, *[n.split()[0] for n in FETCHED.split(", ")]])

    schema = StructType([*rows.schema.fields, *StructType.fromDDL(FETCHED).fields])
    return rows.repartition(concurrency).mapInArrow(run, schema)

