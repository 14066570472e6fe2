"""Published tables in the shape of the engine's own, derived from the driver's star schema.

A customer stands for a parcel, an order for a permit, the least supplier of an order for
its contractor. Each derivation is written twice, as DataFrame and as SQL, and the run date is
fixed. Nothing here reads more columns than it needs.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as c

RUN_DATE = date(2002, 1, 1)
HOME_NATION = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def coordinates(key: str) -> tuple[Column, Column]:
    lat = F.lit(27.55) + ((F.col(key) * 7919) % 8500).cast("double") / F.lit(10000.0)
    lng = F.lit(-81.70) + ((F.col(key) * 104729) % 8500).cast("double") / F.lit(10000.0)
    return lat, lng


def parcel_of(key: Column) -> Column:
    return F.concat(F.lit("P"), key.cast("string"))


def contractors_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, close, contractor_*): the least supplier and the last shipment of each order."""
    per_order = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_suppkey").alias("s_suppkey"), F.max("l_shipdate").cast("date").alias("shipped"))
    who = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return per_order.join(who, "s_suppkey", "left")


def permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    rows = orders.join(contractors_of_orders(spark, sf_dir), "o_orderkey", "left")
    lat, lng = coordinates("o_custkey")
    key, supplier = F.col("o_orderkey"), F.col("s_suppkey")
    rated = supplier % 4 != 0
    issued, closed = F.col("o_orderdate").cast("date"), F.when(F.col("o_orderstatus") == "F", F.col("shipped"))
    run = F.lit(RUN_DATE)
    is_open = (F.col("o_orderstatus") != "F") & closed.isNull()
    return rows.select(
        F.concat(F.lit("I"), key.cast("string")).alias("property_improvement_id"),
        parcel_of(F.col("o_custkey")).alias("parcel_identifier"),
        F.concat(F.lit("B"), key.cast("string")).alias("permit_number"),
        F.when(F.col("o_orderstatus") == "F", "finaled").otherwise("open").alias("improvement_status"),
        F.col("o_orderpriority").alias("improvement_action"),
        issued.cast("string").alias("permit_issue_date"),
        issued.cast("string").alias("opened_date"),
        closed.cast("string").alias("permit_close_date"),
        F.col("o_orderpriority").startswith("1").alias("is_roofing"),
        is_open.alias("is_open"),
        F.datediff(F.when(is_open, run).otherwise(F.coalesce(closed, run)), issued).cast("long").alias("days_open"),
        F.col("o_totalprice").alias("estimated_job_value"),
        F.col("s_name").alias("contractor_name"),
        F.when(supplier % 3 == 0, F.concat(F.lit("CCC"), supplier.cast("string"))).alias("contractor_license"),
        F.when(supplier % 3 == 1, F.lpad(supplier.cast("string"), 10, "4")).alias("contractor_phone"),
        F.concat(F.lit("S"), supplier.cast("string")).alias("contractor_id"),
        F.when(rated, F.when(F.col("s_acctbal") > 5000, "A+").when(F.col("s_acctbal") > 0, "B").otherwise("F")).alias("bbb_rating"),
        F.when(rated, F.when(supplier % 3 == 0, "license").when(supplier % 3 == 1, "phone").otherwise("name")).alias("bbb_match_method"),
        F.when(key % 10 == 0, "osceola_accela").otherwise("osceola_appraiser").alias("source_system"),
        lat.alias("latitude"),
        lng.alias("longitude"),
    )


PERMITS_SQL = """
per_order AS (SELECT l_orderkey AS o_orderkey, min(l_suppkey) AS s_suppkey, CAST(max(l_shipdate) AS DATE) AS shipped FROM lineitem GROUP BY l_orderkey),
permits AS (
  SELECT 'I' || o.o_orderkey AS property_improvement_id, 'P' || o.o_custkey AS parcel_identifier, 'B' || o.o_orderkey AS permit_number,
    CASE WHEN o_orderstatus = 'F' THEN 'finaled' ELSE 'open' END AS improvement_status, o_orderpriority AS improvement_action,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS permit_issue_date, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS opened_date,
    CASE WHEN o_orderstatus = 'F' THEN CAST(shipped AS VARCHAR) END AS permit_close_date,
    o_orderpriority LIKE '1%' AS is_roofing, o_orderstatus <> 'F' AS is_open,
    date_diff('day', CAST(o_orderdate AS DATE), CASE WHEN o_orderstatus <> 'F' THEN DATE '2002-01-01' ELSE coalesce(shipped, DATE '2002-01-01') END) AS days_open,
    o_totalprice AS estimated_job_value, s.s_name AS contractor_name,
    CASE WHEN p.s_suppkey % 3 = 0 THEN 'CCC' || p.s_suppkey END AS contractor_license,
    CASE WHEN p.s_suppkey % 3 = 1 THEN lpad(CAST(p.s_suppkey AS VARCHAR), 10, '4') END AS contractor_phone,
    'S' || p.s_suppkey AS contractor_id,
    CASE WHEN p.s_suppkey % 4 <> 0 THEN CASE WHEN s_acctbal > 5000 THEN 'A+' WHEN s_acctbal > 0 THEN 'B' ELSE 'F' END END AS bbb_rating,
    CASE WHEN p.s_suppkey % 4 <> 0 THEN CASE WHEN p.s_suppkey % 3 = 0 THEN 'license' WHEN p.s_suppkey % 3 = 1 THEN 'phone' ELSE 'name' END END AS bbb_match_method,
    CASE WHEN o.o_orderkey % 10 = 0 THEN 'osceola_accela' ELSE 'osceola_appraiser' END AS source_system,
    CAST(27.55 AS DOUBLE) + CAST((o_custkey * 7919) % 8500 AS DOUBLE) / CAST(10000 AS DOUBLE) AS latitude,
    CAST(-81.70 AS DOUBLE) + CAST((o_custkey * 104729) % 8500 AS DOUBLE) / CAST(10000 AS DOUBLE) AS longitude
  FROM orders o LEFT JOIN per_order p ON p.o_orderkey = o.o_orderkey LEFT JOIN supplier s ON s.s_suppkey = p.s_suppkey
)"""


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("owner_mail_state"))
    roof = permits(spark, sf_dir)
    done = F.col("is_roofing") & ~F.col("is_open")
    roofs = roof.groupBy("parcel_identifier").agg(
        F.count("*").alias("permit_count"),
        F.max(F.when(done, F.coalesce("permit_close_date", "permit_issue_date"))).alias("last_roof_permit_date"),
        F.count_if(F.col("is_roofing") & F.col("is_open")).alias("open_roof_permit_count"),
        F.max(F.when(F.col("is_roofing") & F.col("is_open"), F.col("days_open"))).alias("oldest_open_roof_permit_days"),
        F.bool_or(F.col("bbb_rating").isNotNull()).alias("has_bbb_contractor"),
    )
    key, lat_lng = F.col("c_custkey"), coordinates("c_custkey")
    segment = F.col("c_mktsegment")
    kind = F.when(segment.isin("BUILDING", "HOUSEHOLD"), "residential").when(segment == "MACHINERY", "industrial").when(segment == "FURNITURE", "agricultural").otherwise("commercial")
    rows = customers.join(nations, "c_nationkey", "left").withColumn("parcel_identifier", parcel_of(key)).join(roofs, "parcel_identifier", "left")
    built = F.when(key % 17 != 0, F.lit(1940) + key % 62)
    last = F.col("last_roof_permit_date")
    age = F.when(last.isNotNull(), F.lit(RUN_DATE.year) - F.year(last.try_cast("date"))).otherwise(F.lit(RUN_DATE.year) - built)
    sold = F.date_add(F.lit(date(1985, 1, 1)), ((key * 37) % 6000).cast("int"))
    return rows.select(
        F.concat(F.lit("H"), key.cast("string")).alias("property_id"),
        "parcel_identifier",
        F.concat(F.lit("Unit "), key.cast("string")).alias("address_street"),
        lat_lng[0].alias("latitude"),
        lat_lng[1].alias("longitude"),
        kind.alias("property_type"),
        built.cast("long").alias("built_year"),
        age.cast("long").alias("roof_age_years"),
        F.when(last.isNotNull(), "roof_permit").when(built.isNotNull(), "built_year").otherwise("unknown").alias("roof_age_basis"),
        "last_roof_permit_date",
        F.coalesce("open_roof_permit_count", F.lit(0)).cast("long").alias("open_roof_permit_count"),
        "oldest_open_roof_permit_days",
        F.coalesce("permit_count", F.lit(0)).cast("long").alias("permit_count"),
        F.coalesce("has_bbb_contractor", F.lit(False)).alias("has_bbb_contractor"),
        F.col("c_name").alias("owner_name"),
        F.col("c_name").alias("owners_text"),
        "owner_mail_state",
        (F.col("c_nationkey") != HOME_NATION).alias("owner_out_of_state"),
        sold.cast("string").alias("last_sale_date"),
        c.years_since(sold, RUN_DATE).alias("years_since_sale"),
        F.col("c_acctbal").alias("market_value"),
    )


PROPERTIES_SQL = """
roofs AS (
  SELECT parcel_identifier, count(*) AS permit_count,
    max(CASE WHEN is_roofing AND NOT is_open THEN coalesce(permit_close_date, permit_issue_date) END) AS last_roof_permit_date,
    count(*) FILTER (WHERE is_roofing AND is_open) AS open_roof_permit_count, max(CASE WHEN is_roofing AND is_open THEN days_open END) AS oldest_open_roof_permit_days,
    bool_or(bbb_rating IS NOT NULL) AS has_bbb_contractor
  FROM permits GROUP BY parcel_identifier
),
built AS (SELECT *, 'P' || c_custkey AS parcel, CASE WHEN c_custkey % 17 <> 0 THEN 1940 + c_custkey % 62 END AS year_built, DATE '1985-01-01' + CAST((c_custkey * 37) % 6000 AS INTEGER) AS sold FROM customer),
properties AS (
  SELECT 'H' || c_custkey AS property_id, parcel AS parcel_identifier, 'Unit ' || c_custkey AS address_street,
    CAST(27.55 AS DOUBLE) + CAST((c_custkey * 7919) % 8500 AS DOUBLE) / CAST(10000 AS DOUBLE) AS latitude,
    CAST(-81.70 AS DOUBLE) + CAST((c_custkey * 104729) % 8500 AS DOUBLE) / CAST(10000 AS DOUBLE) AS longitude,
    CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'residential' WHEN c_mktsegment = 'MACHINERY' THEN 'industrial' WHEN c_mktsegment = 'FURNITURE' THEN 'agricultural' ELSE 'commercial' END AS property_type,
    CAST(year_built AS BIGINT) AS built_year,
    CAST(CASE WHEN last_roof_permit_date IS NOT NULL THEN 2002 - year(CAST(last_roof_permit_date AS DATE)) ELSE 2002 - year_built END AS BIGINT) AS roof_age_years,
    CASE WHEN last_roof_permit_date IS NOT NULL THEN 'roof_permit' WHEN year_built IS NOT NULL THEN 'built_year' ELSE 'unknown' END AS roof_age_basis,
    last_roof_permit_date, coalesce(open_roof_permit_count, 0) AS open_roof_permit_count, oldest_open_roof_permit_days, coalesce(permit_count, 0) AS permit_count,
    coalesce(has_bbb_contractor, false) AS has_bbb_contractor, c_name AS owner_name, c_name AS owners_text, n_name AS owner_mail_state, c_nationkey <> 7 AS owner_out_of_state,
    CAST(sold AS VARCHAR) AS last_sale_date, round(date_diff('day', sold, DATE '2002-01-01') / 365.25, 2) AS years_since_sale, c_acctbal AS market_value
  FROM built LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN roofs r ON r.parcel_identifier = parcel
)"""

#: Both tables as common table expressions; a query's own SELECT follows.
WITH_SQL = f"WITH {PERMITS_SQL.strip()},{PROPERTIES_SQL}"
