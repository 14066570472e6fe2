"""A paged service as a Spark data source: one partition a page, pages read by a given function.

The function stands in for the transport. Failed pages are tried again with doubling waits. ``streaming.pages`` reads the
same service as a stream that can be stopped and goes on where it was.
"""

from __future__ import annotations

import shutil
import time
from collections.abc import Callable, Iterable, Iterator
from datetime import date, timedelta
from pathlib import Path
from typing import BinaryIO

from pyspark.sql.datasource import DataSource, DataSourceReader, Filter, GreaterThanOrEqual, InputPartition
from pyspark.sql.types import StructType

PAGE, ATTEMPTS, WAIT_S = 2000, 5, 0.5


class Page(InputPartition):
    def __init__(self, offset: int, size: int):
        super().__init__((offset, size))
        self.offset, self.size = offset, size


def with_retries(call: Callable[[], list], attempts: int = ATTEMPTS, wait: float = WAIT_S) -> list:
    for k in range(attempts):
        try:
            return call()
        except OSError:
            if k + 1 == attempts:
                raise
            time.sleep(wait * 2**k)
    return []


class PagedReader(DataSourceReader):
    """One partition a page; Spark reads as many at once as it has tasks.

    A filter ``since_column >= value`` goes to the service, which ``total(since)`` and
    ``fetch(offset, size, since)`` then answer for changed rows alone; Spark applies all other filters itself.
    """

    def __init__(self, fetch: Callable[[int, int, object], list[tuple]], total: Callable[[object], int], page: int, wait: float, since_column: str | None):
        self.fetch, self.total, self.page, self.wait, self.since_column = fetch, total, page, wait, since_column
        self.since: object = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, GreaterThanOrEqual) and f.attribute == (self.since_column,) and self.since is None:
                self.since = f.value
            else:
                yield f

    def partitions(self) -> list[Page]:
        total = self.total(self.since)
        return [Page(k, min(self.page, total - k)) for k in range(0, total, self.page)]

    def read(self, partition: Page) -> Iterator[tuple]:
        yield from with_retries(lambda: self.fetch(partition.offset, partition.size, self.since), wait=self.wait)


def paged_source(name: str, schema: str, fetch: Callable[[int, int, object], list[tuple]], total: Callable[[object], int], *, page: int = PAGE, wait: float = WAIT_S, since_column: str | None = None) -> type[DataSource]:
    """A DataSource class to register under ``name`` with ``spark.dataSource.register``.

    Filters reach it where ``spark.sql.python.filterPushdown.enabled`` is set.
    """

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema: StructType) -> PagedReader:
            return PagedReader(fetch, total, page, wait, since_column)

    return Paged


def smallest(files: dict[str, int]) -> str | None:
    """The file to probe a source with: the smallest that is not empty, by name among equals."""
    return min((n for n, size in files.items() if size), key=lambda n: (files[n], n), default=None)


def download(open_url: Callable[[str], BinaryIO], url: str, to: str | Path, *, piece: int = 1 << 20, wait: float = WAIT_S) -> Path:
    """A file fetched beside its place and moved there whole, so that a broken download never looks like a file."""
    to = Path(to)
    beside = to.with_name(to.name + ".part")

    def once() -> list:
        with open_url(url) as source, beside.open("wb") as target:
            shutil.copyfileobj(source, target, piece)
        return []

    try:
        with_retries(once, wait=wait)
        beside.replace(to)
    finally:
        beside.unlink(missing_ok=True)
    return to


Window = tuple[date, date]


def bisect(window: Window) -> tuple[Window, Window] | None:
    """Two halves of a window of days, the first one's length rounded down; None for a single day."""
    since, until = window
    days = (until - since).days
    if days < 1:
        return None
    middle = since + timedelta(days=days // 2)
    return (since, middle), (middle + timedelta(days=1), until)


def refresh_window(last_run: date | None, run_date: date, *, overlap_days: int = 14, first_days: int = 90) -> Window:
    """From the last run less the overlap, or ``first_days`` back if there was none, to the run's day."""
    since = run_date - timedelta(days=first_days) if last_run is None else last_run - timedelta(days=overlap_days)
    return since, run_date
