"""Named queries of ingestion: given tables go out in the shapes of the outside world and come back through the sources."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..contracts import PERMITS
from ..functions import formats
from ..operators import digests, leads, publish, upsert, verify
from ..operators.keyed import KeyedTable
from ..sources import artifacts, delimited, harvests, windows
from ..storage import Folder, scratch_path
from ..streaming import pages
from .analogues import WITH_SQL, permits, table
from .build import Asked, History, Loaded, RawStore, Run
from .registry import query
from .services import Dated, Numbered, days_of


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def src_paged_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Customers swept from a paged service by a stream, three pages a batch."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    service, name = Numbered(customers, "c_custkey", "served-customers"), f"customers_{uuid.uuid4().hex}"
    spark.dataSource.register(pages.page_stream(name, "c_custkey long, c_name string, c_acctbal double", service.fetch, service.total, page=500, batch_pages=24))
    return pages.sweep(spark, name, scratch_path(spark, "swept"), scratch_path(spark, "sweep-log"))


#: Loads before and from this moment.
HALF = "TIMESTAMP '2024-01-15 00:00:00'"
#: A day with more orders than this stays capped.
CAP = 8
NUMBERED = "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderkey) AS n FROM orders"


def harvested(spark: SparkSession, sf: str) -> windows.Found:
    orders = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), "o_orderpriority")
    service, name = Dated(orders, "day", "served-orders", CAP), f"orders_{uuid.uuid4().hex}"
    spark.dataSource.register(windows.window_source(name, "o_orderkey long, day date, o_orderpriority string", service.search))
    return windows.harvest(spark, name, days_of(orders, "day"), ["o_orderkey"], concurrency=8)


@query(f"SELECT n.o_orderkey, n.day, o.o_orderpriority FROM ({NUMBERED}) n JOIN orders o ON o.o_orderkey = n.o_orderkey WHERE n <= {CAP}")
def src_window_harvest(spark: SparkSession, sf: str) -> DataFrame:
    """All orders that a search by days with a cap can give."""
    return harvested(spark, sf).hits


@query(f"SELECT day FROM ({NUMBERED}) n GROUP BY day HAVING count(*) > {CAP}")
def src_window_flagged(spark: SparkSession, sf: str) -> DataFrame:
    """Days that a search by days cannot give whole."""
    return harvested(spark, sf).flagged


#: Raw files of orders: one for every 5,000 keys, with a header, short and long rows.
PER_FILE = 5000
RAW = ["key", "status", "price"]
LINE = "CASE WHEN o_orderkey % 97 = 0 THEN concat_ws('|', o_orderkey, o_orderstatus, 'x', 'too', 'many') WHEN o_orderkey % 89 = 0 THEN concat_ws('|', o_orderkey, o_orderstatus) ELSE concat_ws('|', o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderstatus END, CAST(CAST(o_totalprice AS BIGINT) AS {0})) END"


def raw_files(spark: SparkSession, sf: str) -> str:
    rows = table(spark, sf, "orders").select(F.expr(f"CAST(o_orderkey DIV {PER_FILE} AS INT)").alias("file"), "o_orderkey", F.expr(LINE.format("STRING").replace("CAST(o_totalprice AS BIGINT)", "CAST(floor(o_totalprice) AS BIGINT)")).alias("value"))
    headers = rows.select("file").distinct().select("file", F.lit(-1).cast("long").alias("o_orderkey"), F.lit("|".join(RAW)).alias("value"))
    path = scratch_path(spark, "raw-files")
    rows.union(headers).repartition("file").sortWithinPartitions("file", "o_orderkey").select("file", "value").write.partitionBy("file").text(path)
    return path


SQL_LINE = LINE.format("VARCHAR").replace("CAST(o_totalprice AS BIGINT)", "CAST(floor(o_totalprice) AS BIGINT)")


@query(
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS "key", CASE WHEN o_orderkey % 89 <> 0 AND o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 89 <> 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS price, 2024 AS tax_year, 'r1' AS loaded_run_id
    FROM orders WHERE o_orderkey % 97 <> 0"""
)
def src_raw_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Raw files of orders as the bulk loader reads them: short rows padded, long ones set aside, provenance added."""
    path = raw_files(spark, sf)
    loaded = delimited.load_roll(spark, {"orders": f"{path}/*"}, digest=path, loaded={}, tax_year=2024, run_id="r1")
    return loaded.tables["orders"].drop("source_file")


@query(
    f"""SELECT file, CAST(n + 1 AS BIGINT) AS line, 4 AS "column", 'TOO MANY COLUMNS' AS reason, value AS text
    FROM (SELECT o_orderkey, CAST(o_orderkey // {PER_FILE} AS INTEGER) AS file, row_number() OVER (PARTITION BY o_orderkey // {PER_FILE} ORDER BY o_orderkey) AS n, {SQL_LINE} AS value FROM orders) q WHERE o_orderkey % 97 = 0"""
)
def src_reject_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Every row set aside, with its file and line."""
    found = delimited.rejects(spark, f"{raw_files(spark, sf)}/*", columns=RAW)
    return found.withColumn("file", F.regexp_extract("file", r"file=(\d+)", 1).cast("int"))


@query(
    """SELECT c_custkey AS object_id, 'P' || CAST(c_custkey % 400 AS VARCHAR) AS parcel_no, CAST(c_nationkey AS DOUBLE) AS latitude, CAST(-81.5 AS DOUBLE) AS longitude, CAST(1900 + c_custkey % 120 AS INTEGER) AS year_built, c_mktsegment AS dor_code, CAST(NULL AS DATE) AS last_update, c_acctbal AS acres, TIMESTAMP '2024-01-01 00:00:00' AS fetched_at
    FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey % 400 ORDER BY c_custkey DESC) AS n FROM customer) q WHERE n = 1"""
)
def src_ndjson_parcels(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as JSON lines of features, several a parcel: the latest of each."""
    key = F.col("c_custkey")
    told = table(spark, sf, "customer").select(
        key.alias("objectId"), F.concat(F.lit("P"), (key % 400).cast("string")).alias("parcelNo"), F.col("c_nationkey").cast("double").alias("latitude"), F.lit(-81.5).alias("longitude"), (1900 + key % 120).cast("int").alias("yearBuilt"),
        F.col("c_mktsegment").alias("dorCode"), F.lit("no date").alias("lastUpdate"), F.col("c_acctbal").alias("acres"), F.lit("2024-01-01T00:00:00").alias("fetchedAt"),
    )
    path = scratch_path(spark, "features")
    told.write.json(path)
    return harvests.parcels(harvests.read_lines(spark, path, harvests.PARCEL))


@query(
    """SELECT 'E' || CAST(user_id AS VARCHAR) || event_type AS permit_number, arg_max(CAST(event_id AS VARCHAR), event_id) AS description, arg_max(value, event_id) AS job_value, arg_max(event_type, event_id) AS contractor_name, CAST(max(event_id) AS VARCHAR) AS fetched_at
    FROM (SELECT *, 1 AS one FROM events) q GROUP BY user_id, event_type"""
)
def src_ndjson_permits(spark: SparkSession, sf: str) -> DataFrame:
    """Events as nested JSON lines of permits, with broken lines between them: the latest of each number."""
    told = table(spark, sf, "events").select(F.to_json(F.struct(
        F.concat(F.lit("E"), F.col("user_id").cast("string"), "event_type").alias("permitNumber"), F.col("event_id").cast("string").alias("description"), F.col("value").alias("jobValue"),
        F.struct(F.col("event_type").alias("name")).alias("contractor"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("fetchedAt"),
    )).alias("value"))
    path = scratch_path(spark, "permit-lines")
    told.withColumn("value", F.explode(F.array("value", F.lit('{"permitNumber": ')))).write.text(path)
    found = harvests.portal_permits(harvests.read_lines(spark, path, harvests.PERMIT))
    return found.select("permit_number", "description", "job_value", "contractor_name", F.ltrim("fetched_at", F.lit("0")).alias("fetched_at"))


@query(
    """SELECT CAST(c_nationkey AS INTEGER) AS nation, CAST(count(*) AS BIGINT) AS "rows", CAST(1 + any_value(CASE WHEN c_nationkey % 5 <> 0 THEN 1 ELSE 0 END) + any_value(CASE WHEN c_nationkey % 3 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS matched, any_value(c_nationkey % 5 <> 0 OR c_nationkey % 3 <> 0) AS passed
    FROM customer GROUP BY c_nationkey"""
)
def q17_gateways(spark: SparkSession, sf: str) -> DataFrame:
    """Customers by nation, published and fetched from a store and two gateways before it: one lies, one is down for some nations."""
    run, store = scratch_path(spark, "run"), scratch_path(spark, "store")
    table(spark, sf, "customer").repartition("c_nationkey").write.partitionBy("c_nationkey").parquet(run)
    files = [r.asDict() for r in digests.digested(spark, run).collect()]
    made = publish.manifest("run", digests.tree(files), {}, None)
    Folder(spark, run).write(json.dumps(made), "manifest.json")
    digests.publish_run(spark, run, store)
    nation = {a["digest"]: int(a["name"].split("=")[1].split("/")[0]) for a in made["artifacts"] if a["codec"] == "file"}

    def open_url(url: str) -> tuple[int, Iterable[bytes]]:
        kind, rest = url.split(":/", 1)
        status, pieces = verify.from_stores(f"{store}/{rest}")
        of = nation.get(rest.split("/")[0])
        if of is not None and kind == "down" and of % 3 == 0:
            return 504, []
        return status, [b"lie", *pieces] if of is not None and kind == "lying" and of % 5 == 0 else pieces

    report = verify.verify(spark, made, ["store:/", "lying:/", "down:/"], open_url, attempts=2, pace=0.0)
    rows = spark.createDataFrame([(a["name"], int(a["name"].split("=")[1].split("/")[0]), a["rowCount"]) for a in made["artifacts"] if a["codec"] == "file"], "artifact string, nation int, rows long")
    return report.artifacts.join(rows, "artifact").select("nation", "rows", "matched", "passed")


# What is written: exports, keyed tables, run records


@query(f"{WITH_SQL} SELECT permit_number, parcel_identifier, contractor_name, days_open, is_open FROM permits")
def snk_export(spark: SparkSession, sf: str) -> DataFrame:
    """Permits exported along the curve, with their contract's columns, and read back."""
    path = scratch_path(spark, "export")
    publish.export(permits(spark, sf), PERMITS, path, file_rows=20_000)
    return spark.read.parquet(path).select("permit_number", "parcel_identifier", "contractor_name", F.col("days_open").cast("long").alias("days_open"), "is_open")


RECORDED = ["user_id", "event_type"]


@query("SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2")
def snk_keyed_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Events taken into a keyed table week by week, latest week first, so that late rows must not win; one week is given twice."""
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value", "ts").withColumn("week", F.weekofyear("ts"))
    kept = KeyedTable(spark, scratch_path(spark, "keyed"), RECORDED, lambda have: [F.desc("ts"), F.desc("event_id")], buckets=4, most_changes=3)
    weeks = sorted((r[0] for r in events.select("week").distinct().collect()), reverse=True)
    for batch, week in enumerate(weeks):
        for _ in range(1 + (batch == 1)):
            kept.merge(events.where(F.col("week") == week), batch)
    return kept.current().select("user_id", "event_type", "event_id", "value")


@query(
    f"""WITH o AS (SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events WHERE ts < {HALF} GROUP BY 1, 2), n AS (SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events WHERE ts >= {HALF} GROUP BY 1, 2)
    SELECT 'r1' AS run_id, count(*) AS seen, count(*) AS inserted, CAST(0 AS BIGINT) AS changed, count(*) AS stored FROM o
    UNION ALL SELECT 'r2', (SELECT count(*) FROM n), (SELECT count(*) FROM n LEFT JOIN o USING (user_id, event_type) WHERE o.event_id IS NULL), (SELECT count(*) FROM n JOIN o USING (user_id, event_type)), (SELECT count(*) FROM (SELECT user_id, event_type FROM o UNION SELECT user_id, event_type FROM n) u)"""
)
def snk_load_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads of a keyed source into the raw store: what each saw, added and changed, and what the ledger then says is there."""
    named = F.concat_ws("/", *[F.col(c).cast("string") for c in RECORDED]).alias("permit_number")
    events = table(spark, sf, "events").select(named, "event_id", F.col("ts").cast("string").alias("fetched_at"), "ts")
    newest = lambda when: upsert.latest(events.where(when), ["permit_number"], [F.desc("ts"), F.desc("event_id")]).drop("ts")
    store, rows = RawStore(spark, scratch_path(spark, "raw")), []
    for run_id, mode, when in (("r1", "full", f"ts < {HALF}"), ("r2", "incremental", f"ts >= {HALF}")):
        told = store.keep("portal", Loaded(newest(F.expr(when))), Asked(mode, (date(2024, 1, 1), date(2024, 2, 1)), run_id))
        rows.append((run_id, told.seen, told.inserted, told.changed, store.ledger["portal"]["tables"]["portal"]))
    return spark.createDataFrame(rows, "run_id string, seen long, inserted long, changed long, stored long")


@query(
    """WITH d AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, day(min(ts)) AS n, count(*) AS c FROM events GROUP BY CAST(ts AS DATE))
    SELECT run_id, CASE WHEN n % 5 = 0 THEN 'failed' ELSE 'succeeded' END AS status, CASE WHEN n % 3 <> 0 AND n % 7 <> 0 THEN 'root of ' || run_id END AS manifest_root, CASE WHEN n % 3 <> 0 AND n % 7 = 0 THEN 'is broken or lacks root' END AS problem, CAST(c AS BIGINT) AS "rows" FROM d"""
)
def src_run_bundles(spark: SparkSession, sf: str) -> DataFrame:
    """A run for every day of events, some recorded twice, some without a manifest or with a broken one."""
    out = scratch_path(spark, "runs")
    history, folder = History(spark, out), Folder(spark, out)
    days = table(spark, sf, "events").groupBy(F.to_date("ts").cast("string").alias("day")).agg(F.count("*").alias("n")).collect()  # a row a day
    for r in days:
        n = int(r["day"][-2:])
        for status in ("running", "failed" if n % 5 == 0 else "succeeded"):
            history.save(Run(r["day"], "full", status, startedAt=r["day"], runDate=r["day"], tableCounts={"events": r["n"]}))
        if n % 3:
            folder.write("{broken" if n % 7 == 0 else json.dumps({"runId": r["day"], "root": f"root of {r['day']}"}), r["day"], "manifest.json")
    found = artifacts.snapshot(spark, out)
    return found.runs.join(found.warnings.withColumnRenamed("run_id", "runId"), "runId", "left").select(F.col("runId").alias("run_id"), "status", F.col("manifest.root").alias("manifest_root"), "problem", F.col("tableCounts")["events"].alias("rows"))


@query(f"{WITH_SQL} SELECT permit_number, days_open, contractor_name FROM permits WHERE is_roofing AND is_open AND days_open >= 500 AND contractor_name IS NOT NULL ORDER BY days_open DESC, permit_number LIMIT 1000")
def q08_open_permits(spark: SparkSession, sf: str) -> DataFrame:
    """The longest open roofing permits anywhere, as the list of open permits shows them."""
    return leads.open_permits(permits(spark, sf), leads.PermitFilter(min_days_open=500, require_contractor=True), 1000).select("permit_number", "days_open", "contractor_name")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '—' ELSE CASE WHEN o_custkey > 700 THEN '+' ELSE '' END || format('{:,}', o_custkey - 700) END AS delta, '$' || format('{:,}', CAST(round(o_totalprice) AS BIGINT)) AS dollars,
    CASE WHEN o_custkey < 365 THEN o_custkey || ' d' ELSE printf('%.1f', o_custkey / CAST(365.25 AS DOUBLE)) || ' y (' || format('{:,}', o_custkey) || ' d)' END AS open, CASE WHEN length(o_orderpriority) <= 9 THEN o_orderpriority ELSE left(o_orderpriority, 4) || '…' || right(o_orderpriority, 4) END AS short FROM orders"""
)
def fn_formats(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_custkey")
    return table(spark, sf, "orders").select(
        "o_orderkey", formats.delta(F.when(F.col("o_orderkey") % 5 != 0, key - 700)).alias("delta"), formats.dollars("o_totalprice").alias("dollars"), formats.days_open("o_custkey").alias("open"), formats.short_id("o_orderpriority", 4).alias("short"),
    )


@query(f"{WITH_SQL} SELECT permit_number, contractor_name, days_open, row_number() OVER (ORDER BY contractor_name NULLS LAST, permit_number, days_open) AS place FROM (SELECT * FROM permits WHERE is_roofing AND is_open ORDER BY days_open DESC NULLS LAST, permit_number LIMIT 500) q")
def tk_reordered(spark: SparkSession, sf: str) -> DataFrame:
    """The longest open permits, as they are listed by contractor."""
    found = leads.open_permits(permits(spark, sf), limit=500).select("permit_number", "contractor_name", "days_open")
    ordered = leads.reordered(found, "contractor_name", descending=False)
    # At most 500 rows: one task numbers them in the order they came in.
    return ordered.withColumn("place", F.row_number().over(Window.orderBy(F.asc_nulls_last("contractor_name"), "permit_number", "days_open")).cast("long"))
