from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cadastre.contracts import PERMITS, PLACES, TABLES, conform, describe, empty
from cadastre.operators import contractors, digests, guard, kpi, leads, lineage, places, publish, upsert


def rows(df, *columns):
    return sorted(tuple(r[c] for c in (columns or df.columns)) for r in df.collect())


def test_latest_is_a_total_order(spark):
    data = [(1, "a", 5), (1, "b", 5), (1, "c", 4), (2, "d", None)]
    once = rows(upsert.latest(spark.createDataFrame(data, "k int, v string, at int"), ["k"], [F.desc_nulls_last("at")]))
    again = rows(upsert.latest(spark.createDataFrame(data[::-1], "k int, v string, at int").repartition(3), ["k"], [F.desc_nulls_last("at")]))
    assert once == again and len(once) == 2


def test_upsert_and_counts(spark):
    old = spark.createDataFrame([(1, "a", "h1"), (2, "b", "h2")], "k int, v string, h string")
    new = spark.createDataFrame([(2, "B", "h9"), (3, "c", "h3"), (3, "c", "h3")], "k int, v string, h string")
    assert rows(upsert.upsert(old, new, ["k"], [F.asc("v")]), "k", "v") == [(1, "a"), (2, "B"), (3, "c")]
    assert rows(upsert.change_counts(old, new, ["k"], "h")) == [(3, 1, 1)]
    assert rows(upsert.upsert(old, new.limit(0), ["k"], [F.asc("v")]), "k") == [(1,), (2,)]


def test_quality_beats_time(spark):
    data = [("x", None, "2026-02-01"), ("x", "sha", "2026-01-01"), ("y", None, "2026-01-01")]
    df = spark.createDataFrame(data, "id string, rawHtmlSha256 string, fetchedAt string")
    assert [r[1] for r in rows(upsert.latest(df, ["id"], upsert.by_quality()))] == ["sha", None]


def test_lineage(spark):
    first = lineage.carry_lineage(spark.createDataFrame([("a", "1"), ("b", "2"), ("n", None)], "id string, row_hash string"), None, "id", "r1")
    second = lineage.carry_lineage(spark.createDataFrame([("a", "1"), ("b", "3"), ("c", "4"), ("n", None)], "id string, row_hash string"), first, "id", "r2")
    assert rows(second, "id", "first_seen_run_id", "last_changed_run_id") == [("a", "r1", "r1"), ("b", "r1", "r2"), ("c", "r2", "r2"), ("n", "r1", "r2")]


def test_chain(spark):
    runs = [("1", "1", "c1", None), ("2", "2", "c2", "c1"), ("3", "3", None, None), ("4", "4", "c4", "c2"), ("5", "5", "c5", "zz")]
    found = lineage.chain_status(spark.createDataFrame(runs, "run_id string, started_at string, root string, previous_root string"))
    assert [r["chain"] for r in found.orderBy("run_id").collect()] == ["first", "linked", "pending", "linked", "broken"]
    assert [r["run_id"] for r in lineage.merge_history(found, found.limit(1).withColumn("root", F.lit("new"))).collect()] == ["1", "2", "3", "4", "5"]


def staged(spark, data):
    schema = "property_improvement_id string, contractor_license string, contractor_phone string, contractor_name string, contractor_name_norm string, is_roofing boolean, is_open boolean, permit_issue_date date, opened_date date, source_system string"
    full = [(i, lic, tel, name, name, True, False, None, None, "s") for i, lic, tel, name in data]
    return spark.createDataFrame(full, schema)


def test_one_hop_identities(spark):
    data = [("1", "L1", "T1", "N1"), ("2", None, "T1", "N2"), ("3", None, None, "N2"), ("4", None, "T2", "N3"), ("5", None, None, "N3"), ("6", None, None, None), ("7", "L2", "T9", "N9"), ("8", "L3", "T9", "N9"), ("9", None, "T9", None)]
    links = {r["property_improvement_id"]: (r["identity_basis"], r["canonical_key"]) for r in contractors.links(staged(spark, data)).collect()}
    assert links == {
        "1": ("license", "lic:L1"), "2": ("phone", "lic:L1"), "3": ("name", "tel:T1"), "4": ("phone", "tel:T2"), "5": ("name", "tel:T2"),
        "7": ("license", "lic:L2"), "8": ("license", "lic:L3"), "9": ("phone", "tel:T9"),
    }


def test_rating_cascade_and_unlicensed_profiles(spark):
    entities = spark.createDataFrame([("c1", "CCC1", "4075550001", "A"), ("c2", None, "4075550002", "B"), ("c3", None, None, "CEE")], "contractor_id string, license_number string, phone string, normalized_name string")
    data = [("b1", "x", "A+", "1", ["CCC-1"]), ("b2", "y", "B", "407-555-0002", []), ("b3", "Cee", "C", None, None)]
    schema = "bbb_id string, name string, rating string, phone string, license_numbers array<string>"
    profiles = spark.createDataFrame(data, schema).withColumns({n: F.lit(None).cast(t) for n, t in (("accredited", "boolean"), ("review_count", "int"), ("complaint_count", "int"), ("profile_url", "string"))})
    assert rows(contractors.match_ratings(entities, profiles), "contractor_id", "bbb_match_method") == [("c1", "license")]
    assert rows(contractors.match_ratings(entities, profiles, match_unlicensed=True), "contractor_id", "bbb_match_method") == [("c1", "license"), ("c2", "phone"), ("c3", "name")]
    assert contractors.publish(entities, None).columns == TABLES["contractors"].columns


def test_licence_gate(spark):
    df = spark.createDataFrame([(1, ["meta"]), (2, ["OSM"]), (3, [None]), (4, None), (5, ["meta", "OpenStreetMap"])], "k int, source_datasets array<string>")
    assert rows(places.licensed(df), "k") == [(1,), (3,), (4,)]


def test_contracts(spark):
    assert [len(t.columns) for t in TABLES.values()] == [55, 43, 19, 20]
    assert conform(spark.createDataFrame([("x", "5")], "permit_number string, days_open string"), PERMITS).first()["days_open"] == 5
    assert empty(spark, PLACES).columns == PLACES.columns
    assert describe("places")[0] == ("place_id", "string")
    with pytest.raises(ValueError, match="unknown"):
        describe("other")


def properties(spark):
    data = [("A1", 28.2919, -81.4076, 30, "residential", "Jane Doe 100%"), ("A2", 28.30, -81.40, 10, "residential", "x_y"), ("A3", 28.29, -81.41, None, "commercial", None), ("A4", None, None, 50, "other", "z"), ("A5", 27.6, -81.0, 60, "residential", "far")]
    df = spark.createDataFrame(data, "parcel_identifier string, latitude double, longitude double, roof_age_years int, property_type string, owners_text string")
    return df.withColumns({"open_roof_permit_count": F.lit(1), "oldest_open_roof_permit_days": F.lit(1000), "owner_out_of_state": F.lit(True), "years_since_sale": F.lit(3.0)})


def test_radius_search(spark):
    circle = leads.Circle(28.2919, -81.4076, 5)
    found = leads.radius_properties(properties(spark), circle)
    assert [r["parcel_identifier"] for r in found.collect()] == ["A1", "A2", "A3"]
    wanted = leads.PropertyFilter(min_roof_age=15, open_roof_permits=True, open_min_years=2, out_of_state=True, min_years_since_sale=3, types=("residential",), owner_contains="100%", parcels=("A1", "A2"))
    assert [r["parcel_identifier"] for r in leads.radius_properties(properties(spark), circle, wanted).collect()] == ["A1"]
    assert leads.radius_properties(properties(spark), circle, leads.PropertyFilter(owner_contains="x_")).count() == 1
    assert leads.radius_properties(properties(spark), circle, leads.PropertyFilter(owner_contains="J%e")).count() == 0
    assert leads.radius_count(properties(spark), circle).first()["total"] == 3


def test_leads_composite(spark):
    permits = spark.createDataFrame([("A1", "P1", True, True, 900, 28.29, -81.40), ("A1", "P2", True, False, None, 28.29, -81.40), ("A2", "P3", False, True, 5, 28.30, -81.40)], "parcel_identifier string, permit_number string, is_roofing boolean, is_open boolean, days_open int, latitude double, longitude double")
    permits = permits.withColumns({n: F.lit(None).cast("string") for n in ("contractor_name", "bbb_rating", "improvement_status")})
    found = leads.radius_leads(properties(spark), permits, leads.Circle(28.2919, -81.4076, 5), limit=2)
    assert (found.total, found.truncated) == (3, True)
    nested = {r["parcel_identifier"]: [p["permit_number"] for p in r["permits"]] for r in found.properties.collect()}
    assert nested == {"A1": ["P1", "P2"], "A2": []}
    side = leads.radius_leads(properties(spark), permits, leads.Circle(28.2919, -81.4076, 5), permit_side=leads.PermitFilter())
    assert [r["parcel_identifier"] for r in side.properties.collect()] == ["A1"]


@pytest.mark.parametrize("bad", [lambda: leads.Circle(1, 2, 0), lambda: leads.Circle(1, 2, 51), lambda: leads.Circle(float("nan"), 2, 5), lambda: leads.safe_id("x'; DROP"), lambda: leads.PropertyFilter(types=("castle",)).condition(), lambda: leads.PropertyFilter(parcels=()).condition(), lambda: leads.finite("x")])
def test_guards(spark, bad):
    with pytest.raises(ValueError):
        bad()


def test_limits():
    assert [leads.limit_of(n, 500) for n in (None, 0, -3, 5, 5.9, 9999, float("nan"), float("inf"))] == [500, 500, 500, 5, 5, 1000, 500, 500]
    assert [r["k"] for r in leads.resorted([{"k": 1}, {"k": None}, {"k": 3}], "k")] == [3, 1, None]


@pytest.mark.parametrize("sql", ["", "DELETE FROM t", "x" * 20_001, "selective 1"])
def test_statement_guard(sql):
    with pytest.raises(ValueError):
        guard.read_only(sql)


REFUSED = [
    "SELECT 1; SELECT 2", "SELECT * FROM parquet.`/root`", "SELECT * FROM csv.`/etc/passwd`", "SELECT * FROM other", "SELECT * FROM default.t", "SELECT java_method('java.lang.System', 'getProperty', 'user.dir')", "SELECT reflect('a', 'b')",
    "SELECT try_reflect('a', 'b')", "SELECT * FROM range(5)", "SELECT input_file_name() FROM t", "SELECT id FROM t WHERE id IN (SELECT x FROM text.`/etc/hosts`)", "SELECT (SELECT max(value) FROM text.`/etc/hosts`) FROM t",
    "WITH a AS (SELECT reflect('x', 'y') AS r) SELECT * FROM a", "SELECT * FROM identifier('t')", "SELECT transform(id) USING 'cat' FROM t", "WITH a AS (SELECT 1 AS x) INSERT INTO t SELECT x FROM a", "SELECT version()", "SELECT no_such_function(id) FROM t",
    "SELECT upper(java_method('a', 'b')) FROM t", "SELECT sum(id) OVER (ORDER BY java_method('a', 'b')) FROM t", "SELECT transform(array(1), x -> java_method('a', 'b'))", "SELECT id FROM t LATERAL VIEW explode(array(reflect('a', 'b'))) e",
    "SELECT * FROM t JOIN LATERAL (SELECT * FROM orc.`/x`)", "SELECT id FROM t UNION SELECT x FROM json.`/x`", "SELECT id FROM t GROUP BY id HAVING max(java_method('a', 'b')) > 1", "SELECT id FROM t ORDER BY reflect('a', 'b')", "SELECT identifier('id') FROM t", "SELECT * FROM a",
    "SELECT sum(id) OVER w FROM t WINDOW w AS (PARTITION BY reflect('a', 'b'))", "SELECT * FROM (SELECT * FROM t) a, (WITH b AS (SELECT * FROM avro.`/x`) SELECT * FROM b) c",
]


@pytest.mark.parametrize("sql", REFUSED)
def test_what_a_statement_may_not_do(spark, sql):
    with pytest.raises(ValueError):
        guard.run_select(spark, sql, {"t": spark.range(1)})


ALLOWED = {
    "SELECT count(*) AS n FROM t": 7, "SELECT ';' || id AS n FROM t ORDER BY id LIMIT 1": ";0", "WITH a AS (SELECT id FROM t WHERE id > 2), b AS (SELECT max(id) AS n FROM a) SELECT n FROM b": 6, "SELECT (SELECT max(id) FROM t) AS n": 6,
    "SELECT sum(x) AS n FROM t LATERAL VIEW explode(array(id, 1)) e AS x": 28, "SELECT count(*) AS n FROM T WHERE EXISTS (SELECT 1 FROM t u WHERE u.id = t.id + 3)": 4, "SELECT n FROM (SELECT row_number() OVER w AS n, id FROM t WINDOW w AS (ORDER BY id DESC)) q WHERE id = 0;": 7,
    "SELECT id AS n FROM t EXCEPT SELECT id FROM t WHERE id < 6": 6, "SELECT x AS n FROM VALUES (1), (2) AS v(x) WHERE x > 1": 2, "SELECT CASE WHEN id > 5 THEN upper('a') END AS n FROM t ORDER BY 1 DESC LIMIT 1": "A", "SELECT size(filter(array(1, 2, 3), x -> x > 1)) AS n": 2,
    "SELECT count(*) AS n FROM t a JOIN t b ON a.id = b.id GROUP BY ROLLUP(a.id) HAVING count(*) > 5": 7,
}


def test_what_a_statement_may_do(spark):
    assert guard.read_only(" with a as (select 1) select * from a ; ") == "with a as (select 1) select * from a"
    spark.range(3).createOrReplaceTempView("t")
    for sql, n in ALLOWED.items():
        assert guard.run_select(spark, sql, {"t": spark.range(7), "gone": spark.range(1)}).first()["n"] == n, sql
    assert spark.table("t").count() == 3 and not spark.catalog.tableExists("gone")
    spark.catalog.dropTempView("t")


def test_rating_summary(spark):
    schema = "contractor_id string, contractor_name string, bbb_rating string, bbb_match_method string"
    data = [("c1", "a", None, None), ("c1", "a", "A+", "license"), ("c2", "b", None, None), (None, "c", "B", None), (None, None, "A", "x")]
    assert kpi.rating_summary(spark.createDataFrame(data, schema)).first()["sentence"] == "BBB: 2 of 3 contractors matched (license 1, unknown 1); 1 not matched"
    assert kpi.rating_summary(spark.createDataFrame([], schema)).first()["sentence"] == "BBB: no contractor named on the returned permits"
    assert kpi.rating_summary(spark.createDataFrame(data[2:3], schema)).first()["sentence"] == "BBB: 0 of 1 contractors matched in this run"


def test_coverage_of_an_empty_table(spark):
    assert rows(kpi.coverage(spark.createDataFrame([], "a int, b int")), "column", "non_null", "pct") == [("a", 0, 0.0), ("b", 0, 0.0)]


def test_csv_text():
    assert publish.csv_text([{"a": 1, "b": 'x"y'}, {"a": None, "c": "p,q"}]) == 'a,b,c\r\n1,"x""y",\r\n,,"p,q"'


def test_export_and_digests(spark, tmp_path):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "place_id string")
    publish.export(df, PLACES, str(tmp_path / "places"))
    back = spark.read.parquet(str(tmp_path / "places"))
    assert back.columns == PLACES.columns and back.count() == 3
    found = [f.asDict() for f in digests.digested(spark, str(tmp_path / "places")).collect()]
    assert len(found) == 1 and len(found[0]["sha256"]) == 64 and found[0]["rows"] == 3
    made = publish.manifest("r", digests.tree(found), {"places": 3}, None)
    assert len(made["root"]) == 64 and made["previousRoot"] is None and made["artifacts"][0]["rowCount"] == 3


def test_verification(spark):
    checks = [("a", "g1", 1, "x", 1, "x"), ("a", "g2", 1, "x", 1, "x"), ("b", "g1", 1, "x", 1, "x"), ("b", "g2", 1, "y", 1, "x"), ("b", "g1", 1, "x", 1, "x")]
    assert rows(publish.verified(spark.createDataFrame(checks, "artifact string, gateway string, size int, digest string, want_size int, want_digest string"))) == [("a", 2, True), ("b", 1, False)]
