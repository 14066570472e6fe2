"""Keyed tables without primary keys: latest row wins, anti join and union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row a key, the first in ``order``. A hash of whole rows breaks ties, so that reruns agree."""
    tie = F.xxhash64(*[F.col(f.name) for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")])
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order, tie))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def lacking(df: DataFrame, other: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``df`` whose key ``other`` does not have; a key with a null is nowhere."""
    return df.join(other.select(*key), key, "left_anti")


def having(df: DataFrame, other: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``df`` whose key ``other`` has, each once."""
    return df.join(other.select(*key), key, "left_semi")


def marked(df: DataFrame, column: str, known: DataFrame, name: str) -> DataFrame:
    """``df`` with ``name``: whether ``known`` has the value of ``column`` (its only column), null for a null."""
    values = known.select(F.col(known.columns[0]).alias(column)).where(F.col(column).isNotNull()).distinct().withColumn("__known", F.lit(True))
    found = df.join(values, column, "left")
    return found.select(*df.columns, F.when(F.col(column).isNotNull(), F.col("__known").isNotNull()).alias(name))


def stacked(feeds: list[DataFrame]) -> DataFrame:
    """All rows of all feeds by column name; what a feed lacks is null."""
    out = feeds[0]
    for more in feeds[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def upsert(old: DataFrame, new: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """``old`` with its rows replaced by the latest of ``new`` under the same key; new keys are added."""
    fresh = latest(new, key, order)
    return stacked([lacking(old, fresh, key), fresh])


def by_quality(hash_column: str = "rawHtmlSha256", at: str = "fetchedAt") -> list[Column]:
    """Rows with an archived page first, then the latest."""
    return [F.col(hash_column).isNotNull().desc(), F.col(at).desc_nulls_last()]


def with_fallback(full: DataFrame, thin: DataFrame, key: str) -> DataFrame:
    """Rows of ``full``, and of ``thin`` those whose key ``full`` lacks; null keys of ``thin`` are dropped."""
    return stacked([full, lacking(thin.where(F.col(key).isNotNull()), full, [key])])


def change_counts(old: DataFrame, new: DataFrame, key: list[str], hash_column: str) -> DataFrame:
    """One row: seen (rows of ``new``), inserted (keys that ``old`` lacks), changed (rows of another hash)."""
    before = old.select(*key, F.col(hash_column).alias("__old")).dropDuplicates(key)
    joined = new.join(before.withColumn("__known", F.lit(True)), key, "left")
    fresh = F.col("__known").isNull()
    return joined.agg(
        F.count("*").alias("seen"),
        F.count_distinct(F.when(fresh, F.struct(*key))).alias("inserted"),
        F.count_if(~fresh & (F.col("__old") != F.col(hash_column))).alias("changed"),
    )


def overlay(base: DataFrame, detail: DataFrame, key: list[str]) -> DataFrame:
    """``base`` with every value replaced by the one of ``detail`` where that has one."""
    shared = [c for c in base.columns if c in detail.columns and c not in key]
    only = [c for c in detail.columns if c not in base.columns]
    renamed = detail.select(*key, *[F.col(c).alias(f"__{c}") for c in shared], *only)
    joined = base.join(renamed, key, "left")
    return joined.select(*[F.coalesce(f"__{c}", c).alias(c) if c in shared else F.col(c) for c in base.columns], *only)
