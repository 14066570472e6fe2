"""A keyed table on files, merged when it is read: a batch writes what it brings and nothing else.

Rows lie in buckets by a hash of their key. A batch becomes a folder of changes; after ``most_changes`` of them, those
buckets that changed are written anew and the rest stays as it is. A version is one small file that lists the folders it
is made of, written last and whole, so that readers see one version, and a batch that is given twice changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..storage import Folder
from .upsert import having, lacking, latest, stacked

BUCKETS, MOST_CHANGES = 16, 8
BUCKET, BATCH = "key_bucket", "key_batch"


@dataclass
class Version:
    """``batch``: the last one that is in it. ``base``: bucket to folder; ``changes``: batches laid over it, oldest first."""

    batch: int = -1
    base: dict[str, str] = field(default_factory=dict)
    changes: list[int] = field(default_factory=list)
    schema: str | None = None


class KeyedTable:
    """``order`` gives, for the columns there are, which row of a key wins; among equals the one of the later batch.

    With ``newest`` a later batch's row wins whatever the order says, which then holds within a batch alone.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], order: Callable[[list[str]], list[Column]], *, newest: bool = False, buckets: int = BUCKETS, most_changes: int = MOST_CHANGES):
        self.spark, self.folder, self.key, self.order, self.newest = spark, Folder(spark, path), key, order, newest
        self.buckets, self.most = buckets, most_changes

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.folder.names("versions") if n.endswith(".json"))

    def version(self) -> tuple[int, Version]:
        known = self.versions()
        return (known[-1], Version(**json.loads(self.folder.read("versions", f"{known[-1]}.json")))) if known else (-1, Version())

    def put(self, number: int, version: Version) -> None:
        """A new version; the one before it stays for its readers, folders of older ones go."""
        self.folder.write(json.dumps(vars(version)), "versions", f"{number}.json")
        kept = self.versions()[-2:]
        used = set()
        for n in kept:
            v = Version(**json.loads(self.folder.read("versions", f"{n}.json")))
            used |= {f"changes={b}" for b in v.changes} | {f.split("/")[0] for f in v.base.values()}
        for name in self.folder.names():
            if name.startswith(("changes=", "base=")) and name not in used and int(name.split("=")[1]) <= version.batch:
                self.folder.drop(name)
        for n in self.versions()[:-2]:
            self.folder.drop("versions", f"{n}.json")

    def bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int"))

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """Take in one batch; one that is in the table already is left out. Bytes written grow with the batch alone, but for compactions."""
        number, version = self.version()
        if batch_id <= version.batch:
            return
        rows = latest(batch, self.key, self.order(batch.columns)).withColumn(BATCH, F.lit(batch_id))
        self.bucketed(rows).repartition(BUCKET).write.mode("overwrite").option("compression", "zstd").partitionBy(BUCKET).parquet(self.folder.at(f"changes={batch_id}"))
        known = StructType.fromJson(json.loads(version.schema)) if version.schema else StructType()
        merged = StructType([*known.fields, *(f for f in rows.schema.fields if f.name not in known.names)])
        self.put(number + 1, Version(batch_id, version.base, [*version.changes, batch_id], merged.json()))
        if len(version.changes) + 1 >= self.most:
            self.compact()

    def read(self, version: Version, paths: list[str]) -> DataFrame:
        schema = StructType.fromJson(json.loads(version.schema))
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def overlaid(self, version: Version, buckets: set[int] | None = None) -> DataFrame:
        """Rows of a version, with the batch each came in, of all buckets or some.

        Base rows whose key did not change pass through; only the others meet the changes.
        """
        base = self.read(version, [self.folder.at(f) for b, f in version.base.items() if buckets is None or int(b) in buckets])
        parts = [self.folder.at(f"changes={c}", n) for c in version.changes for n in self.folder.names(f"changes={c}") if n.startswith(f"{BUCKET}=") and (buckets is None or int(n.split("=")[1]) in buckets)]
        if not parts:
            return base
        changes = self.read(version, parts)
        changed = changes.select(*self.key).distinct()
        own = self.order(changes.columns)
        order = [F.desc(BATCH), *own] if self.newest else [*own, F.desc(BATCH)]
        return stacked([lacking(base, changed, self.key), latest(stacked([having(base, changed, self.key), changes]), self.key, order)])

    def current(self) -> DataFrame | None:
        """The latest row of each key, None if nothing was merged yet."""
        version = self.version()[1]
        return self.overlaid(version).drop(BATCH) if version.schema else None

    def bucket_of(self, **key: object) -> int:
        rows = self.spark.range(1).select(*[F.lit(key[k]).alias(k) for k in self.key])
        return self.bucketed(rows).first()[BUCKET]

    def row(self, **key: object) -> DataFrame:
        """The row of one key, read from its bucket alone."""
        wanted = F.lit(True)
        for k in self.key:
            wanted = wanted & (F.col(k) == F.lit(key[k]))
        return self.overlaid(self.version()[1], {self.bucket_of(**key)}).where(wanted).drop(BATCH)

    def compact(self) -> None:
        """Write the buckets that have changes anew; the others keep their files."""
        number, version = self.version()
        touched = {int(n.split("=")[1]) for c in version.changes for n in self.folder.names(f"changes={c}") if n.startswith(f"{BUCKET}=")}
        if not touched:
            return
        name = f"base={version.batch}"
        self.bucketed(self.overlaid(version, touched)).repartition(BUCKET).write.mode("overwrite").option("compression", "zstd").partitionBy(BUCKET).parquet(self.folder.at(name))
        base = {b: f for b, f in version.base.items() if int(b) not in touched}
        base |= {n.split("=")[1]: f"{name}/{n}" for n in self.folder.names(name) if n.startswith(f"{BUCKET}=")}
        self.put(number + 1, Version(version.batch, base, [], version.schema))
