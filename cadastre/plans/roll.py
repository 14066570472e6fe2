"""Raw tables in the shapes of the county's feeds, made from the driver's star schema, and the whole build over them.

Each raw column is a rule over the star schema's columns. Permits of the portal are stand-ins made
of the urgent orders. What the build has to make of all of it is told in ``expected``, from the same
star schema and not from the raw texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import contractors, permits, properties
from ..region import COUNTY
from .analogues import RUN_DATE, table
from .build import Inputs, Tables, build

DAY = "CAST(o_orderdate AS DATE)"
K = "CAST(o_orderkey % 1000 AS STRING)"
RAW_PERMIT = {
    "permit_num": "' B' || CAST(o_orderkey AS STRING) || ' '",
    "strap": "'p-' || CAST(o_custkey AS STRING)",
    "status": "CASE o_orderstatus WHEN 'F' THEN 'c' WHEN 'O' THEN 'A' ELSE ' ' END",
    "permit_type": "CASE o_orderkey % 6 WHEN 0 THEN 'RR' WHEN 1 THEN 'PO' WHEN 2 THEN 'FE' WHEN 3 THEN 'SF' WHEN 4 THEN 'XX' END",
    "issue_dt": f"CASE WHEN o_orderkey % 11 = 0 THEN '1899-12-30 00:00:00.000' ELSE CAST({DAY} - older AS STRING) || ' 00:00:00.000' END",
    "submit_dt": f"CAST({DAY} - 10 AS STRING) || ' 00:00:00.000'",
    "key_dt": "CAST(NULL AS STRING)",
    "final_dt": f"CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN CAST({DAY} + 90 AS STRING) ELSE '' END",
    "co_dt": "CAST(NULL AS STRING)",
    "sign_off_dt": f"CASE WHEN o_orderstatus = 'F' AND o_orderkey % 4 = 1 THEN CAST({DAY} + 120 AS STRING) END",
    "cancel_dt": f"CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN CAST({DAY} + 20 AS STRING) END",
    "dscr": "CASE o_orderkey % 7 WHEN 0 THEN 'Re-roof shingle' WHEN 1 THEN 'roof mount solar' WHEN 2 THEN '  ' ELSE 'work ' || o_orderpriority END",
    "est_val": "CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) END",
    "calc_val": "'100'",
    "agency_id": "CASE o_orderkey % 4 WHEN 0 THEN 'C' WHEN 1 THEN 'K' WHEN 2 THEN 's' END",
    "contractor": f"CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'Supplier Roofing ' || {K} ELSE 'LAST, FIRST - Supplier Roofing ' || {K} || ' LLC' END",
    "contractor_tel": f"CASE WHEN o_orderkey % 4 = 0 THEN '(407) 555-' || lpad({K}, 4, '0') WHEN o_orderkey % 4 = 1 THEN '12' END",
    "site_num": "CAST(o_custkey AS STRING)",
    "site_pfx": "' '",
    "site_str": "'MAIN'",
    "site_tp": "CASE WHEN o_custkey % 2 = 0 THEN 'ST' END",
    "site_sfx": "CAST(NULL AS STRING)",
    "site_zip": "'34741'",
}
RAW_PORTAL = {
    "permit_number": "'AC' || CAST(o_orderkey AS STRING)",
    "parcel_number": "'P ' || CAST(o_custkey AS STRING)",
    "status": "CASE o_orderkey % 5 WHEN 0 THEN 'C/O Issued' WHEN 1 THEN 'Withdrawn' WHEN 2 THEN 'Expired' ELSE 'In Review' END",
    "record_type": "CASE WHEN o_orderkey % 4 = 1 THEN 'Residential Roof' ELSE 'PO' END",
    "issued_date": "CAST(NULL AS STRING)",
    "opened_date": f"CAST({DAY} AS STRING)",
    "finaled_date": f"CASE WHEN o_orderkey % 8 = 3 THEN CAST({DAY} + 40 AS STRING) END",
    "closed_date": "CAST(NULL AS STRING)",
    "expiration_date": f"CAST({DAY} + 180 AS STRING)",
    "description": "'portal ' || o_orderpriority",
    "job_value": "CAST(floor(o_totalprice) AS DOUBLE)",
    "contractor_name": "'JOE'",
    "contractor_business_name": f"CASE WHEN o_orderkey % 20 < 10 THEN 'Supplier Roofing ' || {K} END",
    "contractor_phone": f"CASE WHEN o_orderkey % 20 < 15 THEN '1407555' || lpad({K}, 4, '0') END",
    "contractor_license": f"CASE WHEN o_orderkey % 30 < 20 THEN 'ccc-13' || lpad({K}, 5, '0') END",
    "address": "'1 PORTAL WAY'",
    "source_url": "'https://example.org/' || CAST(o_orderkey AS STRING)",
    "fetched_at": "CASE WHEN older > 0 THEN '2001-12-01' ELSE '2001-12-31' END",
}
RAW_PARCEL = {
    "parcel": {"strap": "'p-' || CAST(c_custkey AS STRING)", "dor_cd": "lpad(CAST(c_custkey % 100 AS STRING), 2, '0') || '00'", "jst_val": "CAST(CAST(floor(c_acctbal) AS BIGINT) AS STRING)", "asd_val": "CAST(CAST(floor(c_acctbal / 2) AS BIGINT) AS STRING)", "tot_lnd_val": "' '", "own_dt": "CAST(DATE '1985-01-01' + CAST(c_custkey % 5000 AS INT) AS STRING)"},
    "site": {"strap": "'P' || CAST(c_custkey AS STRING)", "str_num": "CAST(c_custkey AS STRING)", "str_pfx": "' '", "str": "'MAIN'", "str_sfx": "CASE WHEN c_custkey % 2 = 0 THEN 'ST' END", "str_sfx_dir": "CAST(NULL AS STRING)", "str_unit": "CASE WHEN c_custkey % 5 = 0 THEN '7' END", "city": "'KISSIMMEE'", "zip": "CASE WHEN c_custkey % 3 = 0 THEN '347411234' ELSE '34744' END", "bld_num": "CAST(n AS STRING)", "ln_num": "CAST(NULL AS STRING)"},
    "owner": {"strap": "'P' || CAST(c_custkey AS STRING)", "Name": "CASE WHEN n = 3 THEN ' ' ELSE c_name || ' ' || CAST(n AS STRING) END", "ln_num": "CASE WHEN n = 2 THEN NULL ELSE CAST(n AS STRING) END"},
    "mail": {"strap": "'P' || CAST(c_custkey AS STRING)", "addr_1": "CASE WHEN c_custkey % 4 = 0 THEN CAST(c_custkey AS STRING) || ' Main St.' ELSE 'PO BOX 1' END", "city": "'ORLANDO'", "state": "CASE c_nationkey % 3 WHEN 0 THEN 'fl' WHEN 1 THEN 'GA' END", "zip": "CASE WHEN c_custkey % 2 = 0 THEN '34741' WHEN c_custkey % 7 = 0 THEN NULL ELSE '99999' END", "country_cd": "' '", "country": "'US'", "ln_num": "CAST(n AS STRING)"},
    "building": {"strap": "'P' || CAST(c_custkey AS STRING)", "act": "CASE WHEN c_custkey % 6 = 0 THEN '0' ELSE CAST(1940 + c_custkey % 60 + n AS STRING) END", "eff": "CAST(1960 + c_custkey % 40 + n AS STRING)", "heat_ar": "CAST(1000 + c_custkey % 500 AS STRING)", "gross_ar": "CASE WHEN n = 1 THEN 'x' ELSE '1500' END"},
    "detail": {"strap": "'P' || CAST(c_custkey AS STRING)", "acreage": "CASE WHEN c_custkey % 2 = 0 THEN '0.5' END", "sqft": "CASE WHEN c_custkey % 3 = 0 THEN '8712' END", "sub": "CAST(c_nationkey AS STRING)"},
}
#: Copies of a customer's row that a raw table holds.
COPIES = {"site": 2, "owner": 3, "mail": 2, "building": 2}
RAW_SALES = {"strap": "'P' || CAST(o_custkey AS STRING)", "dos": f"CAST({DAY} AS STRING)", "price": "CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) END"}
RAW_DOR = {"dor_cd": "lpad(CAST(p_partkey - 1 AS STRING), 2, '0') || '00'", "dscr": "'use ' || CAST(p_partkey AS STRING)", "dept": "CASE p_partkey % 10 WHEN 0 THEN 'RES' WHEN 1 THEN 'COM' WHEN 2 THEN 'AGR' END"}
RAW_SUB = {"id": "CAST(n_nationkey AS STRING)", "dscr": "n_name"}
PARCELS = {"parcel_no": "'P' || CAST(c_custkey AS STRING)", "latitude": "CAST(27.55 AS DOUBLE) + CAST((c_custkey * 7919) % 8500 AS DOUBLE) / CAST(10000 AS DOUBLE)", "longitude": "CAST(-81.70 AS DOUBLE) + CAST((c_custkey * 104729) % 8500 AS DOUBLE) / CAST(10000 AS DOUBLE)", "year_built": "CAST(1980 AS INT)"}
S = "CAST(s_suppkey AS STRING)"
PROFILES = {
    "bbb_id": f"'0733-' || lpad({S}, 8, '0')", "name": f"CASE WHEN s_suppkey % 2 = 0 THEN 'Supplier Roofing ' || {S} || ' Inc.' ELSE 'Other ' || {S} END", "phone": f"'407-555-' || lpad({S}, 4, '0')",
    "rating": "CASE WHEN s_acctbal > 5000 THEN 'A+' ELSE 'B' END", "accredited": "s_acctbal > 0", "review_count": "CAST(s_suppkey AS INT)", "complaint_count": "CAST(0 AS INT)", "profile_url": f"'https://example.org/p/' || {S}",
    "licence": f"CASE WHEN s_suppkey % 3 = 0 THEN 'CCC-13' || lpad({S}, 5, '0') END",
}
PLACE = {
    "gers_id": "'g' || CAST(c_custkey AS STRING)", "name_primary": "c_name", "taxonomy_primary": "'x'", "taxonomy_hierarchy": "CASE WHEN c_custkey % 2 = 0 THEN 'services/Roofing_contractor' ELSE 'food' END", "basic_category": "'x'",
    "operating_status": "'open'", "confidence": "CAST(0.5 AS DOUBLE)", "phone": "'407555' || lpad(CAST(c_custkey % 60 AS STRING), 4, '0')", "dataset": "CASE c_custkey % 4 WHEN 0 THEN 'OSM' WHEN 1 THEN NULL ELSE 'meta' END",
    "address_freeform": "'x'", "address_locality": "'x'", "address_postcode": "'x'", "longitude": "CAST(1 AS DOUBLE)", "latitude": "CAST(2 AS DOUBLE)", "overture_release": "'2026-08'", "fetched_at": "'2026-09-01'",
}


def chosen(source: DataFrame, columns: dict[str, str]) -> DataFrame:
    return source.selectExpr(*[f"{e} AS `{n}`" for n, e in columns.items()])


def with_older(spark: SparkSession, sf: str, step: int) -> DataFrame:
    """Orders, and of every ``step``-th an older copy."""
    orders = table(spark, sf, "orders").withColumn("older", F.lit(0))
    return orders.union(orders.where(f"o_orderkey % {step} = 3").withColumn("older", F.lit(30)))


def raw_roll(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    customers = table(spark, sf, "customer")
    copies = lambda n: customers.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(COPIES.get(n, 1)))))
    out = {n: chosen(copies(n), e) for n, e in RAW_PARCEL.items()}
    out["permit"] = chosen(with_older(spark, sf, 20), RAW_PERMIT)
    out["sales"] = chosen(table(spark, sf, "orders"), RAW_SALES)
    out["lu_dor"] = chosen(table(spark, sf, "part").where("p_partkey BETWEEN 1 AND 100"), RAW_DOR)
    out["lu_sub"] = chosen(table(spark, sf, "nation"), RAW_SUB)
    return out


def raw_portal(spark: SparkSession, sf: str) -> DataFrame:
    """Urgent orders as permits of the portal."""
    return chosen(with_older(spark, sf, 20).where("o_orderpriority = '1-URGENT'"), RAW_PORTAL)


def parcels(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer's parcel; of each seventh the county has no coordinates and no year."""
    rows = chosen(table(spark, sf, "customer"), PARCELS | {"known": "c_custkey % 7 <> 0"})
    return rows.withColumns({n: F.when(F.col("known"), F.col(n)) for n in PARCELS if n != "parcel_no"}).drop("known")


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    rows = chosen(table(spark, sf, "supplier"), PROFILES)
    return rows.withColumn("license_numbers", F.filter(F.array("licence"), lambda x: x.isNotNull())).drop("licence")


def raw_places(spark: SparkSession, sf: str) -> DataFrame:
    rows = chosen(table(spark, sf, "customer"), PLACE)
    return rows.withColumns({"phones": F.array("phone"), "websites": F.array().cast("array<string>"), "source_datasets": F.array("dataset")}).drop("phone", "dataset")


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return permits.stage([permits.from_roll(raw_roll(spark, sf)["permit"], COUNTY), permits.from_portal(raw_portal(spark, sf), COUNTY)], RUN_DATE)


def entities(spark: SparkSession, sf: str) -> DataFrame:
    return contractors.roll_up(contractors.links(contractors.ways(staged(spark, sf))))


def base(spark: SparkSession, sf: str) -> DataFrame:
    return properties.base(raw_roll(spark, sf), RUN_DATE, parcels(spark, sf))


def built(spark: SparkSession, sf: str) -> Tables:
    inputs = Inputs(raw_roll(spark, sf), raw_portal(spark, sf), parcels(spark, sf), profiles(spark, sf))
    return build(inputs, "run-1", RUN_DATE, fetched_at="2001-12-30")
