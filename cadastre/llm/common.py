"""Shared pieces of the training-data operators: document access. Scratch tables are those of ``storage``."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import drop_stored, stored

#: Write a table once into the shared folder and read it back; delete one that nothing reads any more.
materialise, drop_scratch = stored, drop_stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc(column: str | Column, modulus: int) -> Column:
    """crc32 of an id's decimal text, modulo ``modulus``; a null id counts as the empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string or binary column, one copy a text; a null is empty."""
    return [b"" if (raw := x.as_buffer()) is None else raw.to_pybytes() for x in column]


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Short batches without copies, so that what is made of one stays small."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def long_id(column: str = "doc_id") -> Column:
    """An id of any integer type as a long; text that is no number is an error."""
    return F.col(column).cast("long").alias(column)


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text; a null is an empty text."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def key_bounds(df: DataFrame, key: str, parts: int) -> list[int]:
    """Ascending cut points that split the rows of ``df`` into about ``parts`` equal ranges of ``key``.

    Reads the key column alone and returns fewer than ``parts`` integers, whatever the size of ``df``.
    """
    if parts < 2:
        return []
    at = [k / parts for k in range(1, parts)]
    found = df.agg(F.percentile_approx(key, at, 10_000).alias("at")).first()["at"]
    return sorted(set(found or []))


def range_of(key: Column, bounds: list[int] | list[Column]) -> Column:
    """How many of ``bounds`` (ascending longs, or literals of the key's type) are at most ``key``, by binary search; 0 for a null key."""
    if not bounds:
        return F.lit(0)
    steps = [1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)]
    known = F.array(*[b if isinstance(b, Column) else F.lit(b).cast("long") for b in bounds])

    def step(low: Column, width: Column) -> Column:
        return F.when(F.coalesce(F.get(known, low + width - 1) <= key, F.lit(False)), low + width).otherwise(low)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)
