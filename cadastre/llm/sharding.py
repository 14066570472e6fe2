"""Sharding by proportional stratified interleaving.

Rows of each source are ranked in a seeded shuffle; a row's fractional rank is its rank over
its source's row count. All rows sorted by fractional rank and cut into equal counts give
shards that all have the sources' proportions, within a row per source.

Both rankings run over hashed buckets: rows of a bucket are ranked where they are, and
running sums over the buckets' counts, a small table, add what lies before. No source, however
large, is ever sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, table, text_bytes

#: Rows that a bucket should hold, and the most buckets; beyond it buckets grow.
BUCKET_ROWS, MOST_BUCKETS = 4096, 1 << 16


def shard(docs: DataFrame, shards: int = 16, *, seed: int = 42) -> DataFrame:
    """``docs`` without text, with size, text_crc32, law, shard, slot and grown_shard.

    The law is ``rows``: counts at most one apart. Order among equals: doc_id (nulls first), then
    size and text_crc32; rows alike in all of them are interchangeable, and equal texts are dealt
    as separate rows, since one text may be a third of the table. A null source is a
    stratum of its own, a null text has no bytes. ``slot`` is a row's place in its shard.
    """
    given = docs.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null")).alias("stratum"),
        (F.octet_length(text_bytes()).cast("long") + 1).alias("size"),
        F.crc32(text_bytes()).alias("text_crc32"),
    )
    # 52 bits of a seeded hash: the place in the shuffle. Everything after reads this narrow table.
    place = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("text_crc32").cast("string"))), 1, 13), 16, 10).cast("long")
    rows = materialise(given.withColumn("place", place), "shard-rows")
    total = rows.count()
    buckets = min(MOST_BUCKETS, max(1, -(-total // BUCKET_ROWS)))
    ties = [F.asc_nulls_first("doc_id"), F.col("size"), F.col("text_crc32")]

    def ranked(frame: DataFrame, strata: list[str], bucket: Column, order: list[Column], name: str) -> DataFrame:
        """``frame`` with ``name``: the rank from 0 in each of ``strata``, by bucket and ``order`` within it."""
        frame = frame.withColumn("bucket", bucket)
        before = Window.partitionBy(*strata).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        counts = frame.groupBy(*strata, "bucket").agg(F.count("*").alias("n"))
        lead = materialise(counts.select(*strata, "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lead")), f"shard-{name}")
        within = F.row_number().over(Window.partitionBy(*strata, "bucket").orderBy(*order)) - 1
        return frame.withColumn("within", within).join(lead, [*strata, "bucket"]).withColumn(name, F.col("lead") + F.col("within")).drop("bucket", "lead", "within")

    sizes = materialise(rows.groupBy("stratum").agg(F.count("*").alias("rows")), "shard-sizes")
    # Divided first: 52 bits times the buckets would pass a long's 63 from 2049 buckets on.
    by_source = ranked(rows, ["stratum"], F.floor(F.col("place") / F.lit(float(1 << 52)) * buckets).cast("int"), [F.col("place"), *ties], "rank")
    fraction = (F.col("rank") * 2 + 1) / (F.col("rows").cast("double") * 2)
    mixed = materialise(by_source.join(sizes, "stratum").withColumn("fraction", fraction), "shard-mixed")
    placed = ranked(mixed.withColumn("all", F.lit(0)), ["all"], F.floor(F.col("fraction") * buckets).cast("int"), [F.col("fraction"), F.col("stratum"), *ties], "place_in_all")
    # Shard s holds the places from ceil(s * total / shards) on.
    number = F.expr(f"(place_in_all * {shards}) div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    dealt = placed.withColumn("shard", number).withColumn("slot", F.col("place_in_all") - first)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.when(F.col("stratum") != "null", F.expr("substring(stratum, 2)")).alias("source"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents")).drop("source")
