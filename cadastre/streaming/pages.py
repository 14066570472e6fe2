"""A paged service as a stream: pages are read by executors, and the query's checkpoint says how far it came.

Offsets are row numbers in the service's own order. Each batch takes a bounded number of pages, one partition a page, and
is committed once its rows are in the sink. A killed query that is started again repeats the
batch it was in and none before it, on whatever file system the checkpoint is.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader
from pyspark.sql.types import StructType

from ..sources.paged import PAGE, WAIT_S, Page, with_retries
from ..storage import Folder

#: Pages of one batch: what a crash costs at most, and what is read at once.
BATCH_PAGES = 64

Fetch = Callable[[int, int, object], list[tuple]]
Total = Callable[[object], int]


class PageStream(DataSourceStreamReader):
    def __init__(self, fetch: Fetch, total: Total, page: int, batch_pages: int, wait: float, since: str | None, reached: int):
        self.fetch, self.total, self.page, self.batch, self.wait, self.since, self.at = fetch, total, page, page * batch_pages, wait, since, reached

    def initialOffset(self) -> dict:
        return {"row": 0}

    def latestOffset(self) -> dict:
        """One batch further than last time, and no further than the service now goes."""
        (total,) = with_retries(lambda: [self.total(self.since)], wait=self.wait)
        self.at = max(self.at, min(total, self.at + self.batch))
        return {"row": self.at}

    def partitions(self, start: dict, end: dict) -> list[Page]:
        return [Page(k, min(self.page, end["row"] - k)) for k in range(start["row"], end["row"], self.page)]

    def read(self, partition: Page) -> Iterator[tuple]:
        yield from with_retries(lambda: self.fetch(partition.offset, partition.size, self.since), wait=self.wait)


def page_stream(name: str, schema: str, fetch: Fetch, total: Total, *, page: int = PAGE, batch_pages: int = BATCH_PAGES, wait: float = WAIT_S) -> type[DataSource]:
    """A streaming source to register with ``spark.dataSource.register``.

    Options: ``since`` is handed to the service, which then counts and gives changed rows alone; ``reached``
    is where an earlier query's log ends (``logged_row``), from which batches are counted on.
    """

    class Pages(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def streamReader(self, schema: StructType) -> PageStream:
            return PageStream(fetch, total, page, batch_pages, wait, self.options.get("since"), int(self.options.get("reached", 0)))

    return Pages


def logged_row(spark: SparkSession, checkpoint: str) -> int:
    """The end of the last batch that the query of ``checkpoint`` began, 0 if there was none."""
    log = Folder(spark, checkpoint)
    batches = [int(n) for n in log.names("offsets") if n.isdigit()]
    return json.loads(log.read("offsets", str(max(batches))).splitlines()[-1])["row"] if batches else 0


def sweep(spark: SparkSession, source: str, out: str, checkpoint: str, *, since: str | None = None) -> DataFrame:
    """All rows of the registered ``source`` into Parquet at ``out``, each once; goes on where ``checkpoint`` says.

    A page that fails in spite of its retries fails the sweep; what was committed stays. One checkpoint belongs to one ``since``.
    """
    reader = spark.readStream.format(source).option("reached", logged_row(spark, checkpoint))
    stream = (reader.option("since", since) if since is not None else reader).load()
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.schema(stream.schema).parquet(out)
