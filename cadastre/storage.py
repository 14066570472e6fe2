"""Tables written once into the folder that driver and executors share, and read back.

The lineage of such a table ends at its files: a lost executor costs a reread and never a
recomputation, and all plans over it see the same rows.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Folder of a single-machine session that names none, and the tables written by this process.
_own: list[str] = []
_written: list[str] = []
#: What was stored within the innermost ``scratch`` block, None outside of one.
_block: ContextVar[list[str] | None] = ContextVar("cadastre_scratch", default=None)


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, else the context's checkpoint folder.

    Where neither is set, a single machine (a ``local`` master, as in tests) takes a temporary
    folder; on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="cadastre-"))
        root = _own[0]
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table of its own and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    _written.append(path)
    if (own := _block.get()) is not None:
        own.append(path)
    found = spark.read.schema(df.schema).parquet(path)
    found._scratch = path
    return found


def delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    if path in _written:
        _written.remove(path)


def drop_stored(*tables: DataFrame) -> None:
    """Delete the files of tables that ``stored`` gave, once all that reads them has been written."""
    for df in tables:
        delete(df.sparkSession, df._scratch)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored within the block are deleted at its end; those of others stay."""
    own: list[str] = []
    before = _block.set(own)
    try:
        yield
    finally:
        _block.reset(before)
        for path in own:
            if path in _written:
                delete(spark, path)


def drop_all(spark: SparkSession) -> None:
    """Delete every table this process has stored; for when the results over them have been read."""
    for path in list(_written):
        delete(spark, path)


class Folder:
    """Small files of one folder on any file system that Spark reaches: run records, ledgers, manifests."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, str(root).rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def exists(self, *parts: str) -> bool:
        return self._fs.exists(self._path(self.at(*parts)))

    def names(self, *parts: str) -> list[str]:
        """Names of what lies in a folder; none if it is not there."""
        where = self._path(self.at(*parts))
        return sorted(f.getPath().getName() for f in self._fs.listStatus(where)) if self._fs.exists(where) else []

    def files(self) -> list[tuple[str, str, int]]:
        """(name below the folder, path, bytes) of every file in it, however deep; empty ones too."""
        top = self._fs.makeQualified(self._path(self.root)).toString()
        found, listed = [], self._fs.listFiles(self._path(self.root), True)
        while listed.hasNext():
            f = listed.next()
            found.append((f.getPath().toString()[len(top) + 1 :], f.getPath().toString(), f.getLen()))
        return sorted(found)

    def read(self, *parts: str) -> str | None:
        if not self.exists(*parts):
            return None
        stream = self._fs.open(self._path(self.at(*parts)))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, text: str, *parts: str) -> None:
        """Whole or not at all: written beside the file and renamed over it."""
        target, beside = self._path(self.at(*parts)), self._path(self.at(*parts) + ".part")
        stream = self._fs.create(beside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self._fs.delete(target, False)
        if not self._fs.rename(beside, target):
            raise OSError(f"could not write {self.at(*parts)}")

    def copy(self, source: str, *parts: str) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        given = self._path(source)
        beside = self._path(self.at(*parts) + ".part")
        jvm.org.apache.hadoop.fs.FileUtil.copy(given.getFileSystem(conf), given, self._fs, beside, False, True, conf)
        self._fs.rename(beside, self._path(self.at(*parts)))

    def drop(self, *parts: str) -> None:
        self._fs.delete(self._path(self.at(*parts)), True)
