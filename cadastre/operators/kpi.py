"""Counters: coverage, enrichment, ratings, latency, and the standing example questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import describe
from ..functions.geo import haversine_miles
from ..region import COUNTY, Region


def coverage(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, non_null, rows, pct) for every column, from one pass over the table."""
    names = columns or df.columns
    counts = df.agg(F.count("*").alias("__rows"), *[F.count(F.col(n)).alias(n) for n in names])
    pairs = F.array(*[F.struct(F.lit(n).alias("column"), F.col(n).alias("non_null")) for n in names])
    rows = counts.select("__rows", F.explode(pairs).alias("p")).select("p.column", "p.non_null", F.col("__rows").alias("rows"))
    return rows.withColumn("pct", F.when(F.col("rows") > 0, F.round(F.col("non_null") * 100.0 / F.col("rows").cast("double"), 1)).otherwise(F.lit(0.0)))


def per_source(df: DataFrame, source: str, day: Column) -> DataFrame:
    """(source, rows, earliest, latest)."""
    return df.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("rows"), F.min(day).alias("earliest"), F.max(day).alias("latest"))


def permit_coverage(permits: DataFrame) -> DataFrame:
    return per_source(permits, "source_system", F.coalesce("permit_issue_date", "opened_date"))


def enrichment(permits: DataFrame, region: Region = COUNTY) -> DataFrame:
    rated = F.col("bbb_rating").isNotNull()
    return permits.agg(
        F.count_distinct("contractor_id").alias("contractors"),
        F.count_distinct(F.when(rated, F.col("contractor_id"))).alias("contractors_rated"),
        F.count_if(F.col("contractor_name").isNotNull()).alias("permits_with_contractor"),
        F.count_if(rated).alias("permits_rated"),
        F.count_if(F.col("source_system") == region.portal).alias("permits_portal"),
        F.count("*").alias("permits_total"),
    )


def rated_by_method(permits: DataFrame) -> DataFrame:
    rated = permits.where("bbb_rating IS NOT NULL")
    return rated.groupBy(F.coalesce("bbb_match_method", F.lit("unknown")).alias("bbb_match_method")).agg(F.count_distinct("contractor_id").alias("contractors"))


def rating_summary(permits: DataFrame) -> DataFrame:
    """One row: contractors named, matched, unmatched, and a sentence. A contractor is rated if any of its permits is."""
    key = F.nullif(F.coalesce("contractor_id", "contractor_name"), F.lit(""))
    rated = F.col("bbb_rating").isNotNull() & (F.col("bbb_rating") != "")
    method = F.min(F.when(rated, F.coalesce("bbb_match_method", F.lit("unknown"))))
    each = permits.where(key.isNotNull()).groupBy(key.alias("k")).agg(F.max(rated).alias("rated"), method.alias("method"))
    by = each.groupBy("method").agg(F.count("*").alias("n"), F.count_if("rated").alias("m"))
    listed = F.array_join(F.transform(F.array_sort(F.filter(F.collect_list(F.struct("method", "m")), lambda x: x["method"].isNotNull())), lambda x: F.concat(x["method"], F.lit(" "), x["m"].cast("string"))), ", ")
    total = by.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("contractors"), F.coalesce(F.sum("m"), F.lit(0)).alias("matched"), listed.alias("methods"))
    n, m = F.col("contractors").cast("string"), F.col("matched").cast("string")
    sentence = (
        F.when(F.col("contractors") == 0, "BBB: no contractor named on the returned permits")
        .when(F.col("matched") == 0, F.concat(F.lit("BBB: 0 of "), n, F.lit(" contractors matched in this run")))
        .otherwise(F.concat(F.lit("BBB: "), m, F.lit(" of "), n, F.lit(" contractors matched ("), "methods", F.lit("); "), (F.col("contractors") - F.col("matched")).cast("string"), F.lit(" not matched")))
    )
    return total.select("contractors", "matched", (F.col("contractors") - F.col("matched")).alias("unmatched"), sentence.alias("sentence"))


def nearest_rank(value: str, *shares: float) -> list[Column]:
    """Nearest-rank percentiles p50, p95, ... of a column."""
    return [F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {value})").alias(f"p{round(p * 100)}") for p in shares]


def harvest_totals(summaries: DataFrame) -> DataFrame:
    """Sums over harvest windows, and whether any was cut off."""
    counted = [F.sum(n).alias(n) for n in ("searchHits", "detailsFetched", "detailsFailed", "requestCount")]
    return summaries.agg(*counted, F.bool_or("capped").alias("capped"), F.min("startedAt").alias("startedAt"), F.max("finishedAt").alias("finishedAt"))


def profile_histogram(profiles: DataFrame) -> DataFrame:
    has = F.size(F.coalesce("licenseNumbers", F.array().cast("array<string>"))) > 0
    return profiles.groupBy("rating").agg(F.count("*").alias("profiles"), F.count_if(has).alias("with_license"), F.count_if(F.col("phone").isNotNull()).alias("with_phone"))


def ledger_totals(loads: DataFrame) -> DataFrame:
    return loads.groupBy("source").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.max("fetched_at").alias("fetched_at"))


# The standing example questions


def aged_roofs(properties: DataFrame, region: Region = COUNTY, miles: float = 5) -> DataFrame:
    distance = haversine_miles(*region.anchors["Kissimmee"])
    rows = properties.where((F.col("property_type") == "residential") & (F.col("roof_age_years") >= region.roof_age_years) & (distance <= miles))
    return rows.withColumn("distance_miles", F.round(distance, 2)).orderBy("distance_miles", "parcel_identifier").limit(100)


def aged_by_basis(properties: DataFrame, region: Region = COUNTY, miles: float = 5) -> DataFrame:
    distance = haversine_miles(*region.anchors["Kissimmee"])
    rows = properties.where((F.col("roof_age_years") >= region.roof_age_years) & (distance <= miles))
    return rows.groupBy("roof_age_basis").agg(F.count("*").alias("properties"), F.min("roof_age_years").alias("min_age"), F.max("roof_age_years").alias("max_age"))


def long_open(permits: DataFrame, region: Region = COUNTY) -> DataFrame:
    rows = permits.where(F.col("is_roofing") & F.col("is_open") & (F.col("days_open") > region.long_open_years * 365))
    return rows.withColumn("years_open", F.round(F.col("days_open") / F.lit(365.25), 1)).orderBy(F.desc("days_open"), "permit_number").limit(100)


def open_nearby(permits: DataFrame, region: Region = COUNTY, miles: float = 5) -> DataFrame:
    distance = haversine_miles(*region.anchors["Kissimmee"])
    rows = permits.where(F.col("is_roofing") & F.col("is_open") & (distance <= miles))
    return rows.withColumn("distance_miles", F.round(distance, 2)).orderBy(F.desc("days_open"), "permit_number").limit(100)


def long_held(properties: DataFrame, region: Region = COUNTY) -> DataFrame:
    rows = properties.where((F.col("property_type") == "residential") & (F.col("years_since_sale") >= region.tenure_years))
    return rows.orderBy(F.desc("years_since_sale"), "parcel_identifier").limit(100)


def owners_elsewhere(properties: DataFrame, region: Region = COUNTY) -> DataFrame:
    rows = properties.where("owner_out_of_state").groupBy("owner_mail_state")
    return rows.agg(F.count("*").alias("properties"), F.count_if(F.col("roof_age_years") >= region.roof_age_years).alias("aged_roofs")).orderBy(F.desc("properties"), "owner_mail_state").limit(50)


def busiest_contractors(permits: DataFrame) -> DataFrame:
    rows = permits.where(F.col("is_roofing") & F.col("is_open") & F.col("contractor_name").isNotNull())
    counted = rows.groupBy("contractor_name", "contractor_license", "contractor_phone", "bbb_rating").agg(F.count("*").alias("open_roofing_permits"), F.max("days_open").alias("longest_open_days"))
    return counted.orderBy(F.desc("open_roofing_permits"), "contractor_name").limit(50)


def lead_counters(found: DataFrame) -> DataFrame:
    """The counters above a list of found properties."""
    return found.agg(
        F.count("*").alias("properties"),
        F.count_if(F.col("roof_age_basis") == "roof_permit").alias("by_permit"),
        F.count_if(F.col("roof_age_basis") == "built_year").alias("by_built_year"),
        F.sum("open_roof_permit_count").alias("open_permits"),
        F.max("oldest_open_roof_permit_days").alias("longest_open_days"),
        F.count_if("has_bbb_contractor").alias("with_rated_contractor"),
    )


def described(df: DataFrame, table: str) -> DataFrame:
    """(table, column, type, rows, known) of a published table's columns that ``df`` has: one pass over it."""
    have = [(n, kind) for n, kind in describe(table) if n in df.columns]
    counts = df.agg(F.count("*").alias("rows"), *[F.count(n).alias(n) for n, _ in have])
    told = F.array(*[F.struct(F.lit(n).alias("column"), F.lit(kind).alias("type"), F.col(n).alias("known")) for n, kind in have])
    return counts.select(F.lit(table).alias("table"), "rows", F.explode(told).alias("of")).select("table", "of.column", "of.type", "rows", "of.known")
