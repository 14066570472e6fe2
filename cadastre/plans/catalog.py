"""All named queries of the engine, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import CONTRACTORS, PERMITS, PLACES, PROPERTIES
from ..functions import columns as c
from ..functions import gazetteer
from ..functions.geo import haversine_miles, in_polygon
from ..operators import contractors, guard, kpi, leads, lineage, places, publish, upsert
from ..region import COUNTY
from ..sources import html
from ..storage import stored
from . import expected, ingestion, roll
from .analogues import RUN_DATE, WITH_SQL, permits, properties, table
from .registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES", "ingestion"]

HOME = COUNTY.anchors["Kissimmee"]
CIRCLE = leads.Circle(*HOME, 5)
WIDE = leads.Circle(*HOME, 15)


def miles_sql(lat: float, lng: float) -> str:
    return f"3958.8 * 2 * asin(sqrt(pow(sin(radians(latitude - CAST({lat} AS DOUBLE)) / 2), 2) + cos(radians(CAST({lat} AS DOUBLE))) * cos(radians(latitude)) * pow(sin(radians(longitude - CAST({lng} AS DOUBLE)) / 2), 2)))"


D = miles_sql(*HOME)

# Lead search

LEAD = "property_id, parcel_identifier, property_type, built_year, roof_age_years, roof_age_basis, owner_name"


@query(f"{WITH_SQL} SELECT {LEAD}, distance_miles FROM (SELECT *, round({D}, 2) AS distance_miles FROM properties WHERE roof_age_years >= 15) q WHERE distance_miles <= 5 ORDER BY roof_age_years DESC NULLS LAST, distance_miles, parcel_identifier LIMIT 500")
def q01_radius_aged(spark: SparkSession, sf: str) -> DataFrame:
    found = leads.radius_properties(properties(spark, sf), CIRCLE, leads.PropertyFilter(min_roof_age=15))
    return found.select(*LEAD.split(", "), "distance_miles")


@query(f"{WITH_SQL} SELECT {LEAD}, distance_miles FROM (SELECT *, round({D}, 2) AS distance_miles FROM properties WHERE open_roof_permit_count > 0 AND oldest_open_roof_permit_days >= 731 AND owner_out_of_state AND years_since_sale >= 3 AND property_type IN ('residential', 'commercial') AND owners_text ILIKE '%customer%') q WHERE distance_miles <= 15 ORDER BY roof_age_years DESC NULLS LAST, distance_miles, parcel_identifier LIMIT 50")
def q01_radius_all_filters(spark: SparkSession, sf: str) -> DataFrame:
    wanted = leads.PropertyFilter(open_roof_permits=True, open_min_years=2, out_of_state=True, min_years_since_sale=3, types=("residential", "commercial"), owner_contains="customer")
    return leads.radius_properties(properties(spark, sf), WIDE, wanted, 50).select(*LEAD.split(", "), "distance_miles")


@query(f"{WITH_SQL} SELECT count(*) AS total FROM properties WHERE roof_age_years >= 15 AND {D} <= 5")
def q02_radius_count(spark: SparkSession, sf: str) -> DataFrame:
    return leads.radius_count(properties(spark, sf), CIRCLE, leads.PropertyFilter(min_roof_age=15))


PERMIT = "permit_number, parcel_identifier, improvement_status, days_open, contractor_name, bbb_rating"


@query(f"{WITH_SQL} SELECT {PERMIT}, distance_miles FROM (SELECT *, round({D}, 2) AS distance_miles FROM permits WHERE is_roofing AND is_open AND days_open >= 400 AND contractor_name IS NOT NULL) q WHERE distance_miles <= 5 ORDER BY days_open DESC NULLS LAST, distance_miles, permit_number LIMIT 200")
def q03_radius_open_permits(spark: SparkSession, sf: str) -> DataFrame:
    found = leads.radius_permits(permits(spark, sf), CIRCLE, leads.PermitFilter(min_days_open=400.9, require_contractor=True))
    return found.select(*PERMIT.split(", "), "distance_miles")


@query(f"{WITH_SQL} SELECT * FROM properties WHERE parcel_identifier = 'P77'")
def q04_parcel_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return leads.property_by_parcel(properties(spark, sf), "P77")


@query(f"{WITH_SQL} SELECT {PERMIT} FROM permits WHERE parcel_identifier = 'P77' ORDER BY is_roofing DESC, is_open DESC, permit_issue_date DESC NULLS LAST, permit_number LIMIT 200")
def q05_permits_by_parcel(spark: SparkSession, sf: str) -> DataFrame:
    return leads.permits_by_parcel(permits(spark, sf), "P77").select(*PERMIT.split(", "))


@query(f"{WITH_SQL} SELECT {PERMIT} FROM permits WHERE parcel_identifier IN ('P1', 'P2', 'P3', 'P77', 'P149') AND is_roofing ORDER BY days_open DESC NULLS LAST, permit_number LIMIT 1000")
def q06_permits_for_parcels(spark: SparkSession, sf: str) -> DataFrame:
    return leads.permits_for_parcels(permits(spark, sf), ["P1", "P2", "P3", "P77", "P149"]).select(*PERMIT.split(", "))


@query(
    f"""{WITH_SQL}, found AS (SELECT parcel_identifier, roof_age_years, distance_miles FROM (SELECT *, round({D}, 2) AS distance_miles FROM properties WHERE roof_age_years >= 15) q
    WHERE distance_miles <= 5 ORDER BY roof_age_years DESC NULLS LAST, distance_miles, parcel_identifier LIMIT 100)
    SELECT f.*, coalesce(string_agg(p.permit_number || ':' || p.days_open, ',' ORDER BY p.days_open DESC NULLS LAST, p.permit_number), '') AS permits
    FROM found f LEFT JOIN (SELECT * FROM permits WHERE is_roofing) p ON p.parcel_identifier = f.parcel_identifier GROUP BY ALL"""
)
def q07_radius_leads_nested(spark: SparkSession, sf: str) -> DataFrame:
    found = leads.radius_properties(properties(spark, sf), CIRCLE, leads.PropertyFilter(min_roof_age=15), 100)
    nested = leads.with_permits(found, permits(spark, sf).where("is_roofing"), ["permit_number", "days_open"])
    listed = F.array_join(F.transform("permits", lambda p: F.concat(p["permit_number"], F.lit(":"), p["days_open"].cast("string"))), ",")
    return nested.select("parcel_identifier", "roof_age_years", "distance_miles", listed.alias("permits"))


@query(f"{WITH_SQL}, near AS (SELECT DISTINCT parcel_identifier FROM permits WHERE is_roofing AND is_open AND days_open >= 365) SELECT parcel_identifier, distance_miles FROM (SELECT *, round({D}, 2) AS distance_miles FROM properties WHERE parcel_identifier IN (SELECT parcel_identifier FROM near)) q WHERE distance_miles <= 5 ORDER BY roof_age_years DESC NULLS LAST, distance_miles, parcel_identifier LIMIT 500")
def q07_leads_by_permit_side(spark: SparkSession, sf: str) -> DataFrame:
    found = leads.radius_leads(properties(spark, sf), permits(spark, sf), CIRCLE, permit_side=leads.PermitFilter(min_days_open=365), include_permits=False)
    return found.properties.select("parcel_identifier", "distance_miles")


RING = [(-81.50, 28.10), (-81.20, 28.05), (-81.10, 28.30), (-81.30, 28.20), (-81.45, 28.35)]


def ring_sql() -> str:
    parts = []
    for (ax, ay), (bx, by) in zip(RING, RING[1:] + RING[:1], strict=True):
        parts.append(f"(CASE WHEN ({ay} > latitude) <> ({by} > latitude) AND longitude < CAST({bx - ax!r} AS DOUBLE) * (latitude - CAST({ay} AS DOUBLE)) / CAST({by - ay!r} AS DOUBLE) + CAST({ax} AS DOUBLE) THEN 1 ELSE 0 END)")
    return f"(({' + '.join(parts)}) % 2 = 1)"


@query(f"{WITH_SQL} SELECT parcel_identifier, latitude, longitude FROM properties WHERE {ring_sql()}")
def jn_point_in_polygon(spark: SparkSession, sf: str) -> DataFrame:
    return properties(spark, sf).where(in_polygon(RING)).select("parcel_identifier", "latitude", "longitude")


@query(f"{WITH_SQL} SELECT parcel_identifier FROM properties WHERE latitude BETWEEN 28.1 AND 28.3 AND longitude BETWEEN -81.5 AND -81.2 ORDER BY parcel_identifier LIMIT 200")
def q_area_box(spark: SparkSession, sf: str) -> DataFrame:
    from ..region import Box

    return leads.in_area(properties(spark, sf), box=Box(28.1, 28.3, -81.5, -81.2)).select("parcel_identifier")


@query(f"{WITH_SQL} SELECT min(latitude) AS min_latitude, max(latitude) AS max_latitude, min(longitude) AS min_longitude, max(longitude) AS max_longitude FROM properties")
def ag_extent(spark: SparkSession, sf: str) -> DataFrame:
    from ..functions.geo import extent_of

    return extent_of(properties(spark, sf))


# Counters and examples


@query(f"{WITH_SQL} SELECT count(DISTINCT contractor_id) AS contractors, count(DISTINCT contractor_id) FILTER (WHERE bbb_rating IS NOT NULL) AS contractors_rated, count(*) FILTER (WHERE contractor_name IS NOT NULL) AS permits_with_contractor, count(*) FILTER (WHERE bbb_rating IS NOT NULL) AS permits_rated, count(*) FILTER (WHERE source_system = 'osceola_accela') AS permits_portal, count(*) AS permits_total FROM permits")
def q11_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.enrichment(permits(spark, sf))


@query(f"{WITH_SQL} SELECT coalesce(bbb_match_method, 'unknown') AS bbb_match_method, count(DISTINCT contractor_id) AS contractors FROM permits WHERE bbb_rating IS NOT NULL GROUP BY 1")
def q11_rated_by_method(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.rated_by_method(permits(spark, sf))


@query(f"{WITH_SQL} SELECT parcel_identifier, built_year, roof_age_years, roof_age_basis, round({D}, 2) AS distance_miles FROM properties WHERE property_type = 'residential' AND roof_age_years >= 15 AND {D} <= 5 ORDER BY distance_miles, parcel_identifier LIMIT 100")
def q12a_aged_roofs(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.aged_roofs(properties(spark, sf)).select("parcel_identifier", "built_year", "roof_age_years", "roof_age_basis", "distance_miles")


@query(f"{WITH_SQL} SELECT roof_age_basis, count(*) AS properties, min(roof_age_years) AS min_age, max(roof_age_years) AS max_age FROM properties WHERE roof_age_years >= 15 AND {D} <= 5 GROUP BY roof_age_basis")
def q12b_aged_by_basis(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.aged_by_basis(properties(spark, sf))


@query(f"{WITH_SQL} SELECT permit_number, days_open, round(days_open / 365.25, 1) AS years_open, contractor_name FROM permits WHERE is_roofing AND is_open AND days_open > 5 * 365 ORDER BY days_open DESC, permit_number LIMIT 100")
def q12c_long_open(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.long_open(permits(spark, sf)).select("permit_number", "days_open", F.col("years_open").cast("double").alias("years_open"), "contractor_name")


@query(f"{WITH_SQL} SELECT permit_number, days_open, contractor_name, bbb_rating, round({D}, 2) AS distance_miles FROM permits WHERE is_roofing AND is_open AND {D} <= 5 ORDER BY days_open DESC, permit_number LIMIT 100")
def q12d_open_nearby(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.open_nearby(permits(spark, sf)).select("permit_number", "days_open", "contractor_name", "bbb_rating", "distance_miles")


@query(f"{WITH_SQL} SELECT parcel_identifier, owner_name, last_sale_date, years_since_sale FROM properties WHERE property_type = 'residential' AND years_since_sale >= 10 ORDER BY years_since_sale DESC, parcel_identifier LIMIT 100")
def q12e_long_held(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.long_held(properties(spark, sf)).select("parcel_identifier", "owner_name", "last_sale_date", "years_since_sale")


@query(f"{WITH_SQL} SELECT owner_mail_state, count(*) AS properties, count(*) FILTER (WHERE roof_age_years >= 15) AS aged_roofs FROM properties WHERE owner_out_of_state GROUP BY owner_mail_state ORDER BY properties DESC, owner_mail_state LIMIT 50")
def q12f_owners_elsewhere(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.owners_elsewhere(properties(spark, sf))


@query(f"{WITH_SQL} SELECT contractor_name, contractor_license, contractor_phone, bbb_rating, count(*) AS open_roofing_permits, max(days_open) AS longest_open_days FROM permits WHERE is_roofing AND is_open AND contractor_name IS NOT NULL GROUP BY 1, 2, 3, 4 ORDER BY open_roofing_permits DESC, contractor_name LIMIT 50")
def q12g_busiest_contractors(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.busiest_contractors(permits(spark, sf))


@query(
    f"""{WITH_SQL} SELECT 'permits' AS "table", column_name AS "column", CAST(rows AS BIGINT) AS "rows", CAST(known AS BIGINT) AS known FROM (SELECT count(*) AS rows, count(permit_number) AS a, count(permit_close_date) AS b, count(contractor_license) AS c, count(is_open) AS d, count(days_open) AS e FROM permits) p,
    LATERAL (VALUES ('permit_number', a), ('permit_close_date', b), ('contractor_license', c), ('is_open', d), ('days_open', e)) AS v(column_name, known)"""
)
def q13_schema(spark: SparkSession, sf: str) -> DataFrame:
    """The published columns of the permits that were read, with how many rows have each: what a caller may ask about."""
    wanted = ["permit_number", "permit_close_date", "contractor_license", "is_open", "days_open"]
    found = kpi.described(permits(spark, sf), "permits")
    return found.where(F.col("column").isin(wanted)).select("table", "column", "rows", "known")


@query(f"{WITH_SQL} SELECT source_system AS source, count(*) AS \"rows\", min(coalesce(permit_issue_date, opened_date)) AS earliest, max(coalesce(permit_issue_date, opened_date)) AS latest FROM permits GROUP BY 1")
def q14_permit_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.permit_coverage(permits(spark, sf))


@query(
    f"""{WITH_SQL}, one AS (SELECT coalesce(contractor_id, contractor_name) AS k, max(bbb_rating IS NOT NULL AND bbb_rating <> '') AS rated, min(CASE WHEN bbb_rating IS NOT NULL AND bbb_rating <> '' THEN coalesce(bbb_match_method, 'unknown') END) AS method FROM permits WHERE coalesce(contractor_id, contractor_name) <> '' GROUP BY 1),
    t AS (SELECT count(*) AS n, count(*) FILTER (WHERE rated) AS m FROM one), l AS (SELECT string_agg(method || ' ' || k, ', ' ORDER BY method) AS s FROM (SELECT method, count(*) AS k FROM one WHERE rated GROUP BY method) b)
    SELECT n AS contractors, m AS matched, n - m AS unmatched, 'BBB: ' || m || ' of ' || n || ' contractors matched (' || s || '); ' || (n - m) || ' not matched' AS sentence FROM t, l"""
)
def q15_rating_summary(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.rating_summary(permits(spark, sf))


@query(f"{WITH_SQL} SELECT count(*) AS properties, count(*) FILTER (WHERE roof_age_basis = 'roof_permit') AS by_permit, count(*) FILTER (WHERE roof_age_basis = 'built_year') AS by_built_year, CAST(sum(open_roof_permit_count) AS BIGINT) AS open_permits, max(oldest_open_roof_permit_days) AS longest_open_days, count(*) FILTER (WHERE has_bbb_contractor) AS with_rated_contractor FROM properties")
def ag_lead_counters(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.lead_counters(properties(spark, sf))


COVERED = ["parcel_identifier", "built_year", "last_roof_permit_date", "oldest_open_roof_permit_days", "owner_mail_state"]


@query(f"{WITH_SQL} " + " UNION ALL ".join(f"SELECT '{n}' AS \"column\", count({n}) AS non_null, count(*) AS \"rows\", round(count({n}) * 100.0 / count(*), 1) AS pct FROM properties" for n in COVERED))
def ag_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.coverage(properties(spark, sf), COVERED)


@query("SELECT event_type, percentile_disc(0.5) WITHIN GROUP (ORDER BY value) AS p50, percentile_disc(0.95) WITHIN GROUP (ORDER BY value) AS p95 FROM events GROUP BY event_type")
def ag_nearest_rank(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy("event_type").agg(*kpi.nearest_rank("value", 0.5, 0.95))


@query(
    """WITH w AS (SELECT CAST(ts AS DATE) AS d, count(*) AS hits, count(*) FILTER (WHERE event_type = 'purchase') AS fetched, count(*) FILTER (WHERE event_type = 'error') AS failed, max(value) > 990 AS capped FROM events GROUP BY 1)
    SELECT CAST(sum(hits) AS BIGINT) AS "searchHits", CAST(sum(fetched) AS BIGINT) AS "detailsFetched", CAST(sum(failed) AS BIGINT) AS "detailsFailed", CAST(sum(hits) AS BIGINT) AS "requestCount", bool_or(capped) AS capped, CAST(min(d) AS VARCHAR) AS "startedAt", CAST(max(d) AS VARCHAR) AS "finishedAt" FROM w"""
)
def ag_harvest_totals(spark: SparkSession, sf: str) -> DataFrame:
    day, kind = F.to_date("ts").cast("string"), F.col("event_type")
    windows = table(spark, sf, "events").groupBy(day.alias("startedAt")).agg(F.count("*").alias("searchHits"), F.count_if(kind == "purchase").alias("detailsFetched"), F.count_if(kind == "error").alias("detailsFailed"), (F.max("value") > 990).alias("capped"))
    return kpi.harvest_totals(windows.withColumns({"requestCount": F.col("searchHits"), "finishedAt": F.col("startedAt")}))


@query("SELECT event_type AS source, CAST(sum(user_id) AS BIGINT) AS \"rows\", CAST(sum(event_id) AS BIGINT) AS bytes, max(ts) AS fetched_at FROM events GROUP BY 1")
def ag_ledger_totals(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.ledger_totals(table(spark, sf, "events").select(F.col("event_type").alias("source"), F.col("user_id").alias("rows"), F.col("event_id").alias("bytes"), F.col("ts").alias("fetched_at")))


# Keys, upserts, change

CUT = "TIMESTAMP '2024-01-15 00:00:00'"


@query("SELECT event_id, user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) q WHERE n = 1")
def wn_latest_wins(spark: SparkSession, sf: str) -> DataFrame:
    found = upsert.latest(table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts"), ["user_id"], [F.desc("ts"), F.desc("event_id")])
    return found.drop("ts")


@query("SELECT user_id, event_type FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS n FROM events GROUP BY user_id, event_type) q WHERE n = 1")
def wn_mode_name(spark: SparkSession, sf: str) -> DataFrame:
    return contractors.most_frequent(table(spark, sf, "events").select("user_id", "event_type"), "user_id", "event_type")


#: Two feeds of one table, a user's events of one kind being one record: what came before a day, and what came from it on.
RECORD = ["user_id", "event_type"]
SPLIT = "TIMESTAMP '2024-01-28 00:00:00'"


def halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The latest event of each record before a day, and all events from it on."""
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return upsert.latest(events.where(F.expr(f"ts < {SPLIT}")), RECORD, [F.desc("ts"), F.desc("event_id")]), events.where(F.expr(f"ts >= {SPLIT}"))


def newest_sql(name: str, when: str) -> str:
    return f"{name} AS (SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events WHERE {when} GROUP BY 1, 2)"


@query("SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2")
def snk_upsert(spark: SparkSession, sf: str) -> DataFrame:
    old, new = halves(spark, sf)
    return upsert.upsert(old, new, RECORD, [F.desc("ts"), F.desc("event_id")]).drop("ts")


@query("SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY (CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END), ts DESC, event_id DESC) AS n FROM events) q WHERE n = 1")
def snk_upsert_quality(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").withColumn("rawHtmlSha256", F.when(F.col("event_type") == "purchase", "x")).withColumn("fetchedAt", F.struct("ts", "event_id"))
    return upsert.latest(rows.drop("props"), ["user_id"], upsert.by_quality()).select("user_id", "event_id")


@query(
    f"""WITH {newest_sql("old", f"ts < {SPLIT}")}, rated AS (SELECT n.user_id, n.event_type, o.event_id AS before, n.value > 500 AS now, o.value > 500 AS was FROM events n LEFT JOIN old o USING (user_id, event_type) WHERE n.ts >= {SPLIT})
    SELECT count(*) AS seen, count(DISTINCT CASE WHEN before IS NULL THEN user_id || '/' || event_type END) AS inserted, count(CASE WHEN now <> was THEN 1 END) AS changed FROM rated"""
)
def snk_change_counts(spark: SparkSession, sf: str) -> DataFrame:
    old, new = (df.withColumn("high", F.col("value") > 500) for df in halves(spark, sf))
    return upsert.change_counts(old, new, RECORD, "high")


HASHED = ["event_type", "value", "event_id"]
HASH_SQL = "sha256(concat_ws('|', event_type, printf('%.6f', value), CAST(event_id AS VARCHAR)))"


@query(
    f"""WITH {newest_sql("first", f"ts < {SPLIT}")}, {newest_sql("second", "ts >= TIMESTAMP '2024-01-03 00:00:00'")}
    SELECT s.user_id || '/' || s.event_type AS record, CASE WHEN f.user_id IS NULL THEN 'run-2' ELSE 'run-1' END AS first_seen_run_id, CASE WHEN f.event_id = s.event_id THEN 'run-1' ELSE 'run-2' END AS last_changed_run_id,
      sha256(concat_ws('|', s.event_type, printf('%.6f', s.value), CAST(s.event_id AS VARCHAR))) AS row_hash FROM second s LEFT JOIN first f USING (user_id, event_type)"""
)
def cdc_lineage(spark: SparkSession, sf: str) -> DataFrame:
    """Two snapshots that overlap: a record may be in one of them alone, alike in both, or changed."""
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")

    def snapshot(when: str) -> DataFrame:
        newest = upsert.latest(events.where(when), RECORD, [F.desc("ts"), F.desc("event_id")])
        return newest.select(F.concat_ws("/", *RECORD).alias("record"), c.row_hash(HASHED, {"value"}).alias("row_hash"))

    first = lineage.carry_lineage(snapshot(f"ts < {SPLIT}"), None, "record", "run-1")
    return lineage.carry_lineage(snapshot("ts >= TIMESTAMP '2024-01-03 00:00:00'"), first, "record", "run-2")


@query(f"SELECT event_id, {HASH_SQL} AS row_hash FROM events")
def cdc_row_hash(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", c.row_hash(HASHED, {"value"}).alias("row_hash"))


RUNS_SQL = """r AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS started_at, CASE WHEN day(min(ts)) % 5 <> 0 THEN 'c' || min(event_id) END AS root FROM events GROUP BY CAST(ts AS DATE)),
p AS (SELECT *, last_value(root IGNORE NULLS) OVER (ORDER BY started_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM r),
runs AS (SELECT *, CASE WHEN CAST(right(run_id, 2) AS INTEGER) % 7 = 0 THEN 'other' WHEN root IS NOT NULL THEN prior END AS previous_root FROM p)"""


@query(f"WITH {RUNS_SQL} SELECT run_id, CASE WHEN prior IS NULL THEN CASE WHEN previous_root IS NOT NULL THEN 'broken' ELSE 'first' END WHEN root IS NULL AND previous_root IS NULL THEN 'pending' WHEN previous_root = prior THEN 'linked' ELSE 'broken' END AS chain FROM runs")
def cdc_chain_status(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    day = F.to_date("ts").cast("string")
    runs = table(spark, sf, "events").groupBy(day.alias("run_id")).agg(F.when(F.day(F.min("ts")) % 5 != 0, F.concat(F.lit("c"), F.min("event_id").cast("string"))).alias("root")).withColumn("started_at", F.col("run_id"))
    prior = F.last("root", ignorenulls=True).over(Window.orderBy("started_at").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("previous_root", F.when(F.right("run_id", F.lit(2)).cast("int") % 7 == 0, "other").when(F.col("root").isNotNull(), prior))
    return lineage.chain_status(runs).select("run_id", "chain")


@query("WITH a AS (SELECT event_type AS name, count(*) AS \"rows\" FROM events GROUP BY 1), b AS (SELECT event_type AS name, count(*) AS \"rows\" FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00' AND event_type <> 'error' GROUP BY 1) SELECT a.name, a.\"rows\", a.\"rows\" - coalesce(b.\"rows\", 0) AS delta FROM a LEFT JOIN b ON a.name = b.name")
def ag_deltas(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(F.col("event_type").alias("name"), "ts")
    counted = lambda df: df.groupBy("name").agg(F.count("*").alias("rows"))
    return lineage.table_deltas(counted(events), counted(events.where(F.expr(f"ts < {CUT} AND name <> 'error'"))))


@query("SELECT artifact, count(DISTINCT CASE WHEN good THEN gateway END) AS matched, count(DISTINCT CASE WHEN good THEN gateway END) >= 2 AS passed FROM (SELECT user_id AS artifact, event_type AS gateway, value > 300 AS good FROM events) q GROUP BY artifact")
def q17_verified(spark: SparkSession, sf: str) -> DataFrame:
    good = F.col("value") > 300
    checks = table(spark, sf, "events").select(F.col("user_id").alias("artifact"), F.col("event_type").alias("gateway"), F.lit(1).alias("size"), F.lit(1).alias("want_size"), F.when(good, "a").otherwise("b").alias("digest"), F.lit("a").alias("want_digest"))
    return publish.verified(checks)


# Joins and sets


@query("SELECT c_custkey AS k, c_name AS name, CAST(NULL AS DOUBLE) AS balance, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'supplier' FROM supplier")
def st_union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "customer").select(F.lit("customer").alias("kind"), F.col("c_name").alias("name"), F.col("c_custkey").alias("k"))
    b = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance"))
    return upsert.stacked([a, b])


@query("SELECT c_custkey AS k, c_name AS name FROM customer WHERE c_acctbal > 2000 UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 2000)")
def src_fallback_union(spark: SparkSession, sf: str) -> DataFrame:
    full = table(spark, sf, "customer").where("c_acctbal > 2000").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return upsert.with_fallback(full, table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")), "k")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%')")
def jn_anti(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").where(F.col("o_orderpriority").startswith("1")).select(F.col("o_custkey").alias("c_custkey"))
    return upsert.lacking(table(spark, sf, "customer"), orders, ["c_custkey"]).select("c_custkey", "c_name")


@query("SELECT c_custkey, CASE WHEN c_nationkey IS NULL THEN NULL ELSE c_nationkey NOT IN (SELECT s_nationkey FROM supplier) END AS elsewhere FROM customer")
def jn_mark(spark: SparkSession, sf: str) -> DataFrame:
    found = upsert.marked(table(spark, sf, "customer"), "c_nationkey", table(spark, sf, "supplier").select("s_nationkey"), "local")
    return found.select("c_custkey", (~F.col("local")).alias("elsewhere"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def jn_semi(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return upsert.having(table(spark, sf, "customer"), orders, ["c_custkey"]).select("c_custkey", "c_name")


@query("SELECT o_orderkey, d.c_name, d.c_acctbal IS NOT NULL AS has_detail, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN 'late' END, o_orderstatus) AS status FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) d ON d.c_custkey = o_custkey")
def src_overlay(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"))
    who = table(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name", F.lit(True).alias("seen"))
    joined = upsert.overlay(orders, who, ["o_custkey"])
    late = upsert.overlay(joined, orders.where("o_orderkey % 2 = 0").select("o_orderkey", F.lit("late").alias("status")), ["o_orderkey"])
    return late.select("o_orderkey", "c_name", F.coalesce("seen", F.lit(False)).alias("has_detail"), "status")


# Functions



def fn(name: str, source: str, key: str, /, **columns: tuple[Callable[[], Column], str]) -> None:
    """A query of column functions over one table, and the same in SQL."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        return table(spark, sf, source).select(key, *[make().alias(n) for n, (make, _) in columns.items()])

    QUERIES[name] = run
    ORACLES[name] = f"SELECT {key}, " + ", ".join(f"{sql} AS {n}" for n, (_, sql) in columns.items()) + f" FROM {source}"


def pad(k: Column) -> Column:
    return F.concat(F.lit("  "), k, F.lit(" "))


WORDS_SQL = "(" + c.CORPORATE + ")"
NAME = "'The ' || c_name || ', Inc. - ' || c_mktsegment || ' Roofing & Sons L.L.C.'"
name_text = lambda: F.concat(F.lit("The "), "c_name", F.lit(", Inc. - "), "c_mktsegment", F.lit(" Roofing & Sons L.L.C."))
PHONE = "CASE WHEN c_custkey % 3 = 0 THEN '1-407-' WHEN c_custkey % 3 = 1 THEN '(407) ' ELSE '7-' END || lpad(CAST(c_custkey AS VARCHAR), 7, '5')"
phone_text = lambda: F.concat(F.when(F.col("c_custkey") % 3 == 0, "1-407-").when(F.col("c_custkey") % 3 == 1, "(407) ").otherwise("7-"), F.lpad(F.col("c_custkey").cast("string"), 7, "5"))

fn(
    "fn_text", "part", "p_partkey",
    txt=(lambda: c.txt(F.when(F.col("p_partkey") % 3 == 0, "   ").otherwise(pad(F.col("p_name")))), "nullif(trim(CASE WHEN p_partkey % 3 = 0 THEN '   ' ELSE '  ' || p_name || ' ' END), '')"),
    clean=(lambda: c.clean_text(F.concat(F.lit(" \t"), F.col("p_name"), F.lit("\n  x"))), "nullif(trim(regexp_replace(' ' || chr(9) || p_name || chr(10) || '  x', '\\s+', ' ', 'g')), '')"),
    label=(lambda: c.label_key(F.concat(F.col("p_brand"), F.lit(" : "))), "p_brand"),
    untagged=(lambda: c.strip_tags(F.concat(F.lit("<b>"), F.col("p_name"), F.lit("</b> &amp; <i>more</i>"))), "trim(p_name || ' & more')"),
    title=(lambda: c.slug_title(F.concat(F.lit("roof-repair_"), F.lower("p_type"))), "'Roof Repair ' || upper(left(lower(p_type), 1)) || substr(lower(p_type), 2)"),
)
fn(
    "fn_numbers", "part", "p_partkey",
    num=(lambda: c.num(F.when(F.col("p_partkey") % 4 == 0, "n/a").otherwise(pad(F.col("p_retailprice").cast("string")))), "CASE WHEN p_partkey % 4 <> 0 THEN p_retailprice END"),
    whole=(lambda: c.lenient_int(F.concat(F.col("p_size").cast("string"), F.lit(".5"))), "CAST(p_size + 1 AS BIGINT)"),
    year=(lambda: c.year_of((F.col("p_partkey") % 400 + 1650).cast("string"), RUN_DATE), "CASE WHEN p_partkey % 400 + 1650 BETWEEN 1700 AND 2003 THEN CAST(p_partkey % 400 + 1650 AS BIGINT) END"),
    money=(lambda: c.money(F.concat(F.lit("$ "), F.format_number("p_retailprice", 2))), "round(p_retailprice, 2)"),
    bucket=(lambda: c.improvement_type(F.col("p_size") % 7 == 0, F.element_at(F.array(*map(F.lit, ["SCRR", "po", "FE", "SF", "REPR", "DM", "??"])), (F.col("p_size") % 7 + 1).cast("int"))), "CASE p_size % 7 WHEN 0 THEN 'Roofing' WHEN 1 THEN 'Pool' WHEN 2 THEN 'Fence' WHEN 3 THEN 'New construction' WHEN 4 THEN 'Addition / alteration' WHEN 5 THEN 'Demolition' ELSE 'Other' END"),
    agency=(lambda: c.agency(F.element_at(F.array(*map(F.lit, [" c", "K", "s ", "x"])), (F.col("p_size") % 4 + 1).cast("int"))), "CASE p_size % 4 WHEN 0 THEN 'Osceola County' WHEN 1 THEN 'City of Kissimmee' WHEN 2 THEN 'City of St. Cloud' END"),
    use=(lambda: c.use_class(F.when(F.col("p_size") % 5 == 0, "COM"), F.lpad((F.col("p_size") * 2).cast("string"), 4, "0")), "CASE WHEN p_size % 5 = 0 AND substr(lpad(CAST(p_size * 2 AS VARCHAR), 4, '0'), 1, 2) > '09' THEN 'commercial' ELSE 'residential' END"),
)
fn(
    "fn_dates", "orders", "o_orderkey",
    source_date=(lambda: c.source_date(F.when(F.col("o_orderkey") % 5 == 0, "1899-12-30 00:00:00.000").otherwise(F.col("o_orderdate").cast("string"))), "CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END"),
    iso=(lambda: c.iso_date(F.date_format("o_orderdate", "M/d/yyyy")), "strftime(o_orderdate, '%Y-%m-%d')"),
    portal=(lambda: c.portal_date(F.to_date("o_orderdate").cast("string")), "strftime(o_orderdate, '%m/%d/%Y')"),
    years=(lambda: c.years_since(F.to_date("o_orderdate"), RUN_DATE), "round(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') / 365.25, 2)"),
    epoch=(lambda: c.epoch_date(F.unix_millis(F.col("o_orderdate").cast("timestamp"))), "strftime(o_orderdate, '%Y-%m-%d')"),
    run=(lambda: c.run_id_to_iso(F.concat(F.to_date("o_orderdate").cast("string"), F.lit("T10-42-08Z-full"))), "strftime(o_orderdate, '%Y-%m-%d') || 'T10:42:08Z'"),
    status=(lambda: c.roll_status(F.when(F.col("o_orderkey") % 3 == 0, F.lit(" v")).when(F.col("o_orderkey") % 3 == 1, "a"), F.when(F.col("o_orderstatus") == "F", F.to_date("o_orderdate")), F.lit(None).cast("date")), "CASE o_orderkey % 3 WHEN 0 THEN 'voided' WHEN 1 THEN 'open' ELSE CASE WHEN o_orderstatus = 'F' THEN 'finaled' ELSE 'open' END END"),
    portal_status=(lambda: c.portal_status(F.element_at(F.array(*map(F.lit, ["C/O Issued", "Withdrawn", "Permit Expired", "In Review"])), (F.col("o_orderkey") % 4 + 1).cast("int")), F.when(F.col("o_orderstatus") == "F", F.lit("x")), F.lit(None).cast("string")), "CASE o_orderkey % 4 WHEN 0 THEN 'finaled' WHEN 1 THEN 'voided' WHEN 2 THEN 'expired' ELSE CASE WHEN o_orderstatus = 'F' THEN 'finaled' ELSE 'open' END END"),
)
fn(
    "fn_identity", "customer", "c_custkey",
    parcel=(lambda: c.parcel_key(F.concat(F.lit(" a-"), F.col("c_name"))), "upper(regexp_replace(' a-' || c_name, '[^A-Za-z0-9]', '', 'g'))"),
    phone=(lambda: c.phone10(phone_text()), f"CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE right(regexp_replace({PHONE}, '[^0-9]', '', 'g'), 10) END"),
    name=(lambda: c.normalized_name(name_text()), f"nullif(trim(regexp_replace(regexp_replace(regexp_replace(upper({NAME}), '[^A-Z0-9 ]', ' ', 'g'), '\\b{WORDS_SQL}\\b', ' ', 'g'), ' +', ' ', 'g')), '')"),
    business=(lambda: c.business_part(name_text()), "c_mktsegment || ' Roofing & Sons L.L.C.'"),
    person=(lambda: c.person_part(name_text()), "'The ' || c_name || ', Inc.'"),
    license=(lambda: c.license_number(F.concat(F.lit("Lic. No: CCC-"), F.col("c_custkey").cast("string"), F.lit("/7"))), "'CCC' || c_custkey || '7'"),
    licenses=(lambda: F.array_join(c.license_numbers(F.concat(F.lit("has cbc 12"), F.lpad(F.col("c_custkey").cast("string"), 5, "0"), F.lit(", CCC-99"), F.lpad(F.col("c_custkey").cast("string"), 5, "0"))), ","), "'CBC12' || lpad(CAST(c_custkey AS VARCHAR), 5, '0') || ',CCC99' || lpad(CAST(c_custkey AS VARCHAR), 5, '0')"),
    grade=(lambda: c.rating(F.element_at(F.array(*map(F.lit, ["a +", "B", "NR", "f"])), (F.col("c_custkey") % 4 + 1).cast("int"))), "CASE c_custkey % 4 WHEN 0 THEN 'A+' WHEN 1 THEN 'B' WHEN 3 THEN 'F' END"),
    profile=(lambda: c.profile_id(F.concat(F.lit("https://x.org/us/profile/roofing/abc-0733-900"), F.col("c_custkey").cast("string"), F.lit("?a=1"))), "'0733-900' || c_custkey"),
    url=(lambda: c.canonical_url(F.concat(F.lit("https://x.org/p/"), F.col("c_custkey").cast("string"), F.lit("/?q=1#top"))), "'https://x.org/p/' || c_custkey"),
    urls=(lambda: F.array_join(c.split_urls(F.concat(F.lit(" a | b|a || "), F.col("c_name"))), ";"), "'a;b;' || c_name"),
    merged=(lambda: F.array_join(c.merged_unique(F.array(F.lit("x"), F.col("c_name")), F.array(F.lit(None).cast("string"), F.lit("x"), F.lit("y"))), ";"), "'x;' || c_name || ';y'"),
    key=(lambda: c.surrogate_key(F.lit("osceola"), F.col("c_custkey")), "substr(sha256('osceola:' || c_custkey), 1, 32)"),
    kind=(lambda: c.media_type(F.concat(F.col("c_name"), F.when(F.col("c_custkey") % 2 == 0, ".json").otherwise(".bin"))), "CASE WHEN c_custkey % 2 = 0 THEN 'application/json' ELSE 'application/octet-stream' END"),
    http=(lambda: c.http_class((F.col("c_custkey") % 5 * 100 + 104)), "CASE c_custkey % 5 WHEN 1 THEN 'ok' WHEN 4 THEN 'transient' ELSE 'permanent' END"),
)
fn(
    "fn_haversine", "customer", "c_custkey",
    miles=(lambda: F.round(haversine_miles(*HOME, F.lit(27.55) + ((F.col("c_custkey") * 7919) % 8500).cast("double") / 10000.0, F.lit(-81.70) + ((F.col("c_custkey") * 104729) % 8500).cast("double") / 10000.0), 2),
           "round(" + D.replace("latitude", "(CAST(27.55 AS DOUBLE) + CAST((c_custkey * 7919) % 8500 AS DOUBLE) / CAST(10000 AS DOUBLE))").replace("longitude", "(CAST(-81.70 AS DOUBLE) + CAST((c_custkey * 104729) % 8500 AS DOUBLE) / CAST(10000 AS DOUBLE))") + ", 2)"),
)
fn(
    "fn_coercion", "orders", "o_orderkey",
    number=(lambda: c.coerced_number(F.when(F.col("o_orderkey") % 4 == 0, F.col("o_totalprice").cast("string")).when(F.col("o_orderkey") % 4 == 1, F.concat(F.lit("-"), F.col("o_custkey").cast("string"))).when(F.col("o_orderkey") % 4 == 2, "1e").otherwise(" 7")), "CASE o_orderkey % 4 WHEN 0 THEN o_totalprice WHEN 1 THEN -CAST(o_custkey AS DOUBLE) END"),
    flag=(lambda: c.coerced_flag(F.element_at(F.array(*map(F.lit, ["true", "false", "True", "1"])), (F.col("o_orderkey") % 4 + 1).cast("int"))), "CASE o_orderkey % 4 WHEN 0 THEN true WHEN 1 THEN false END"),
    text=(lambda: c.coerced_text(F.col("o_orderkey") * 1_000_003), "CAST(o_orderkey * 1000003 AS VARCHAR)"),
    record=(lambda: c.url_value(F.concat(F.lit("https://x.org/d.aspx?capID1=A"), F.col("o_orderkey").cast("string"), F.lit("&capID2=&m=1")), "capID1"), "'A' || o_orderkey"),
    blank=(lambda: c.url_value(F.concat(F.lit("https://x.org/d.aspx?capID1=A"), F.col("o_orderkey").cast("string"), F.lit("&capID2=&m=1")), "capID2"), "CAST(NULL AS VARCHAR)"),
)
ROOF_SQL = f"(regexp_matches(lower(text), '{c.ROOF_WORDS}') AND NOT regexp_matches(lower(text), '{c.NOT_ROOF_WORDS}'))"


@query("SELECT p_partkey, upper(p_type) LIKE '%ROOF%' OR p_size % 9 = 0 AND p_size % 2 = 0 AS roofing FROM part")
def prj_roofing(spark: SparkSession, sf: str) -> DataFrame:
    description = F.when(F.col("p_size") % 9 == 0, F.when(F.col("p_size") % 2 == 0, "Re-Roof, shingle").otherwise("reroof under SOLAR array")).otherwise("fence")
    return table(spark, sf, "part").select("p_partkey", c.is_roofing("p_type", description).alias("roofing"))


@query(f"SELECT doc_id, {ROOF_SQL} AS roofing FROM (SELECT doc_id, text || CASE WHEN doc_id % 3 = 0 THEN ' new roof' WHEN doc_id % 3 = 1 THEN ' roof mount pv' ELSE '' END AS text FROM documents) d")
def prj_roofing_text(spark: SparkSession, sf: str) -> DataFrame:
    extra = F.when(F.col("doc_id") % 3 == 0, " new roof").when(F.col("doc_id") % 3 == 1, " roof mount pv").otherwise("")
    return table(spark, sf, "documents").select("doc_id", c.is_roofing(F.lit(None).cast("string"), F.concat("text", extra)).alias("roofing"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def fn_json(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", c.json_number("props", "$.k").cast("bigint").alias("k"))


ASKED = {0: ("Saint Cloud, FL", "St. Cloud"), 1: ("kissimmee", "Kissimmee"), 2: ("Narco", "Narcoossee"), 3: ("nowhere", None), 4: ("BVL", "Buenaventura Lakes")}
#: The answers as a table: place, latitude and longitude of each question.
GAZETTEER = ", ".join(f"({k}, '{asked}', " + (f"'{place}', CAST({gazetteer.PLACES[place][0]} AS DOUBLE), CAST({gazetteer.PLACES[place][1]} AS DOUBLE))" if place else "NULL, NULL, NULL)") for k, (asked, place) in ASKED.items())


@query(f"SELECT c_custkey, asked, place, place_lat, place_lng FROM customer JOIN (VALUES {GAZETTEER}) AS g(k, asked, place, place_lat, place_lng) ON c_custkey % 5 = k")
def fn_geocode(spark: SparkSession, sf: str) -> DataFrame:
    names = F.element_at(F.array(*[F.lit(asked) for asked, _ in ASKED.values()]), (F.col("c_custkey") % 5 + 1).cast("int"))
    return gazetteer.locate_all(spark, table(spark, sf, "customer").select("c_custkey", names.alias("asked")), "asked")


@query("SELECT page_id, regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host FROM pages")
def src_url_host(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.coalesce(c.url_host("url"), F.lit("")).alias("host"))


def plain_sql(text: str) -> str:
    """Text of markup without tags: entities read, white space closed up."""
    for name, c in (("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        text = f"replace({text}, '{name}', '{c}')"
    return f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"


@query(
    rf"""SELECT url, nullif({plain_sql("regexp_extract(h, '<title>([^<]*)</title>', 1)")}, '') AS title, CAST(len(regexp_extract_all(h, '<h[1-6][ >]')) AS INTEGER) AS headings, CAST(len(regexp_extract_all(h, '<a [^>]*href="[^"]+"')) AS INTEGER) AS links, CAST(length({plain_sql("regexp_replace(h, '<[^>]*>', '', 'g')")}) AS INTEGER) AS characters
    FROM (SELECT url, regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<(script|style)[ >].*?</(script|style)>', '', 'gs') AS h FROM pages) p"""
)
def src_page_outline(spark: SparkSession, sf: str) -> DataFrame:
    return html.parse_pages(table(spark, sf, "pages"), html.page_outline, "url string, title string, headings int, links int, characters int").drop("parse_error")


@query(f"{WITH_SQL} SELECT improvement_status, count(*) AS n FROM permits GROUP BY improvement_status")
def guard_sql(spark: SparkSession, sf: str) -> DataFrame:
    return guard.run_select(spark, "SELECT improvement_status, count(*) AS n FROM permits GROUP BY improvement_status;", {"permits": permits(spark, sf)})


@query(f"{WITH_SQL} SELECT parcel_identifier, roof_age_years FROM properties WHERE roof_age_years >= 15 AND property_type = 'residential' ORDER BY roof_age_years DESC, parcel_identifier LIMIT 500")
def topk_aged_sample(spark: SparkSession, sf: str) -> DataFrame:
    return publish.aged_roof_sample(properties(spark, sf)).select("parcel_identifier", "roof_age_years")


@query(f"{WITH_SQL} SELECT permit_number, days_open FROM permits WHERE is_roofing AND is_open ORDER BY days_open DESC NULLS LAST, permit_number LIMIT 500")
def topk_long_open_sample(spark: SparkSession, sf: str) -> DataFrame:
    return publish.long_open_sample(permits(spark, sf)).select("permit_number", "days_open")


# The build, on the roll's shapes


STAGED = [
    "property_improvement_id", "property_id", "permit_number", "parcel_identifier", "improvement_status", "improvement_action", "improvement_type", "permit_issue_date", "application_received_date", "final_inspection_date", "permit_close_date",
    "completion_date", "expiration_date", "opened_date", "source_system", "description", "estimated_job_value", "issuing_agency", "contractor_name", "contractor_qualifier", "contractor_phone", "contractor_license", "contractor_name_norm",
    "address_street", "address_city", "address_zip", "source_url", "fetched_at", "is_roofing", "is_open", "days_open", "row_hash",
]
ENTITY = ["contractor_id", "display_name", "normalized_name", "license_number", "phone", "identity_basis", "permit_count", "roofing_permit_count", "open_roofing_permit_count", "first_permit_date", "last_permit_date", "source_systems"]
MATCHED = ["contractor_id", "bbb_id", "bbb_match_method", "bbb_rating", "bbb_accredited", "bbb_review_count", "bbb_complaint_count", "bbb_profile_url"]
BASED = [
    "property_id", "request_identifier", "parcel_identifier", "source_system", "county_name", "state_code", "address_street", "address_city", "address_zip", "latitude", "longitude", "lot_size_acre", "lot_area_sqft", "property_type",
    "property_usage_type", "built_year", "effective_year", "livable_floor_area", "total_area", "assessed_value", "market_value", "land_value", "owner_name", "owners_text", "owner_count", "owner_occupied", "last_sale_date", "last_sale_price",
    "subdivision", "owner_mail_city", "owner_mail_state", "owner_mail_country", "owner_out_of_county", "owner_out_of_state", "gis_year_built",
]


@query(expected.sql("stage", STAGED))
def build_permits_stage(spark: SparkSession, sf: str) -> DataFrame:
    return roll.staged(spark, sf).select(*STAGED)


@query(expected.sql("alias", ["alias_key", "canonical_key"]))
def er_alias(spark: SparkSession, sf: str) -> DataFrame:
    return contractors.aliases(roll.staged(spark, sf))


@query(expected.sql("links", ["property_improvement_id", "identity_basis", "identity_key", "canonical_key", "contractor_id"]))
def er_links(spark: SparkSession, sf: str) -> DataFrame:
    # Aliases and links both read the permits: what they need of them is written once.
    return contractors.links(stored(roll.staged(spark, sf).select("property_improvement_id", *contractors.NAMED), "staged")).select(*contractors.LINK)


@query(expected.sql("entities", ENTITY))
def er_contractors(spark: SparkSession, sf: str) -> DataFrame:
    return roll.entities(spark, sf).select(*ENTITY)


@query(expected.sql("matched", MATCHED))
def er_match_cascade(spark: SparkSession, sf: str) -> DataFrame:
    return contractors.match_ratings(roll.entities(spark, sf), roll.profiles(spark, sf)).select(*MATCHED)


@query(expected.sql("matched", MATCHED, unlicensed=True))
def er_match_unlicensed(spark: SparkSession, sf: str) -> DataFrame:
    return contractors.match_ratings(roll.entities(spark, sf), roll.profiles(spark, sf), match_unlicensed=True).select(*MATCHED)


@query(expected.sql("base", BASED))
def build_properties_base(spark: SparkSession, sf: str) -> DataFrame:
    return roll.base(spark, sf).select(*BASED)


@query(expected.sql("final_permits", PERMITS.columns, fetched_at="2001-12-30"))
def build_permits(spark: SparkSession, sf: str) -> DataFrame:
    return roll.built(spark, sf).permits


@query(expected.sql("final_properties", PROPERTIES.columns))
def build_properties(spark: SparkSession, sf: str) -> DataFrame:
    return roll.built(spark, sf).properties


@query(expected.sql("(SELECT * FROM entities LEFT JOIN matched USING (contractor_id))", CONTRACTORS.columns))
def build_contractors(spark: SparkSession, sf: str) -> DataFrame:
    return roll.built(spark, sf).contractors


@query(expected.sql("final_places", PLACES.columns))
def build_places(spark: SparkSession, sf: str) -> DataFrame:
    return places.publish(places.licensed(roll.raw_places(spark, sf)), roll.entities(spark, sf))
