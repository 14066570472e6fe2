"""Continuous ingestion, an extension: the batch engine's overlapping windows as a stream.

Files that land in a folder are read as a stream; late copies of a record within the overlap
are dropped by watermark, and each micro-batch is taken into a keyed table, which writes the
batch alone and merges when it is read. A table belongs to one checkpoint, whose batch numbers it goes by.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.keyed import KeyedTable

OVERLAP = "14 days"


def read_drops(spark: SparkSession, folder: str, schema: str, at: str = "fetchedAt") -> DataFrame:
    """JSON lines of a folder as a stream, with ``event_time`` from their fetch time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 100).json(folder).withColumn("event_time", F.col(at).try_cast("timestamp"))


def without_repeats(stream: DataFrame, key: list[str], overlap: str = OVERLAP, at: str = "fetchedAt") -> DataFrame:
    """Copies of one fetch of a record are dropped, however late within the overlap; other fetches of it all stay."""
    return stream.where("event_time IS NOT NULL").withWatermark("event_time", overlap).dropDuplicatesWithinWatermark([*key, at])


def latest_fetch(at: str = "fetchedAt") -> Callable[[list[str]], list[Column]]:
    """Order for a ``KeyedTable`` in which a late row never replaces a newer one."""
    return lambda columns: [F.col(at).desc_nulls_last()]


def start_merge(stream: DataFrame, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """All files that are there, in batches, then stop; call again for more."""
    def take(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch.drop("event_time"), batch_id)

    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, window: str = "1 day", late: str = OVERLAP) -> DataFrame:
    """Records by window of event time; a window is final once the watermark passes it."""
    return stream.withWatermark("event_time", late).groupBy(F.window("event_time", window)).agg(F.count("*").alias("records"))
