"""Exports and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import Contract, conform
from ..functions.geo import curve_key
from ..region import COUNTY, Region
from ..storage import drop_stored, stored
from .digests import Tree

#: Rows of a row group: what a reader skips or reads at once.
ROW_GROUP = 16_384
#: Rows of one exported file; a larger table becomes several, each a range of the order.
FILE_ROWS = 2_000_000


def export_order(table: Contract) -> list[Column]:
    """Along the space-filling curve where a table has coordinates, so that a box reads few row groups; then by key."""
    names = table.schema.names
    near = [curve_key("latitude", "longitude")] if {"latitude", "longitude"} <= set(names) else []
    return [*near, F.col(table.key)]


def export(df: DataFrame, table: Contract, path: str, *, file_rows: int = FILE_ROWS, group_rows: int = ROW_GROUP) -> None:
    """The contract's columns in ``export_order``, as ZSTD Parquet: one file, or ranges beyond ``file_rows``.

    Lookups by key, which the curve scatters, are answered by a Bloom filter of each row group.
    """
    rows, order = stored(conform(df, table), "export"), export_order(table)
    files = max(1, -(-rows.count() // file_rows))
    ordered = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    written = ordered.write.mode("overwrite").option("compression", "zstd").option("parquet.block.row.count.limit", group_rows).option(f"parquet.bloom.filter.enabled#{table.key}", True)
    written.parquet(path)
    drop_stored(rows)


def aged_roof_sample(properties: DataFrame, region: Region = COUNTY, limit: int = 500) -> DataFrame:
    rows = properties.where((F.col("roof_age_years") >= region.roof_age_years) & F.col("latitude").isNotNull() & (F.col("property_type") == "residential"))
    return rows.orderBy(F.desc("roof_age_years"), "parcel_identifier").limit(limit)


def long_open_sample(permits: DataFrame, limit: int = 500) -> DataFrame:
    return permits.where("is_roofing AND is_open").orderBy(F.desc_nulls_last("days_open"), "permit_number").limit(limit)


def write_csv(df: DataFrame, path: str) -> None:
    """Header, values quoted only where they must be, CRLF between rows where Spark can (it writes LF)."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def csv_text(rows: list[dict]) -> str:
    """CSV of a few rows: header of all their keys, CRLF lines, quotes where a value has a quote, comma or line break."""
    names = list(dict.fromkeys(k for r in rows for k in r))

    def cell(value: object) -> str:
        text = "" if value is None else str(value)
        return '"' + text.replace('"', '""') + '"' if any(c in text for c in '",\r\n') else text

    return "\r\n".join([",".join(map(cell, names)), *(",".join(cell(r.get(n)) for n in names) for r in rows)])


def manifest(run_id: str, found: Tree, table_counts: dict[str, int], previous_root: str | None) -> dict:
    """A run's manifest: its files and folders by name with codec, size, digest, media type and rows; the root of its tree, and the one it follows."""
    return {"runId": run_id, "root": found.root, "previousRoot": previous_root, "artifacts": found.artifacts, "tableCounts": table_counts}


def verified(checks: DataFrame, least: int = 2) -> DataFrame:
    """(artifact, matched, passed) from checks (artifact, gateway, size, digest, want_size, want_digest)."""
    same = (F.col("size") == F.col("want_size")) & (F.col("digest") == F.col("want_digest"))
    matched = F.count_distinct(F.when(same, F.col("gateway")))
    return checks.groupBy("artifact").agg(matched.alias("matched"), (matched >= least).alias("passed"))
