from __future__ import annotations

from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cadastre.functions import columns as c
from cadastre.functions import gazetteer, geo

RUN = date(2026, 9, 7)


def values(spark, make, *inputs):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(inputs)], "k int, v string")
    return [r["out"] for r in rows.select("k", make("v").alias("out")).orderBy("k").collect()]


CASES = [
    (c.txt, {" a ": "a", "  ": None, None: None, "\t": "\t"}),
    (c.num, {" 12.5 ": 12.5, "1e3": 1000.0, "12d": None, "": None, "x": None, "-.5": -0.5}),
    (c.lenient_int, {"12.5": 13, "13.5": 14, "-0.5": -1, "1e2": 100, "x": None}),
    (lambda v: c.year_of(v, RUN), {"1999": 1999, "1699": None, "2027": 2027, "2028": None}),
    (c.source_date, {"2020-01-02 00:00:00.000": date(2020, 1, 2), "1899-12-30": None, "1900-01-01": None, "2020": None, "2020-13-01": None, None: None}),
    (c.parcel_key, {"25-26 a": "2526A", None: ""}),
    (c.parcel_number, {"--": None, "a1": "A1"}),
    (c.phone10, {"(407) 555-0100": "4075550100", "1-407-555-0100": "4075550100", "2-407-555-0100": None, "12": None, None: None}),
    (c.normalized_name, {"A.B.C. Roofing, LLC": "A B C", "The Company Inc": None, None: None, "Smith & Sons Contractors": "SMITH SONS"}),
    (c.business_part, {"DOE, JANE - ABC ROOFING": "ABC ROOFING", "ABC": "ABC", None: None, "A - ": None}),
    (c.person_part, {"DOE, JANE - ABC ROOFING": "DOE, JANE", "ABC": None}),
    (c.clean_text, {"a  \n b": "a b", " ": None}),
    (c.iso_date, {"9/4/2026 10:00": "2026-09-04", "2026-09-04": None, None: None}),
    (c.portal_date, {"2026-09-04": "09/04/2026", "x": None}),
    (c.money, {"$22,599.00": 22599.0, "n/a": None}),
    (c.label_key, {"Job Value : ": "Job Value"}),
    (c.license_number, {"Lic# CCC-133.0001": "CCC1330001", "abcd": None, "1": None, "LICENSE NO: CBC 12345": "CBC12345"}),
    (lambda v: F.array_join(c.license_numbers(v), ","), {"CCC 1330001, ccc-1330001 and CBC12345.": "CCC1330001,CBC12345", "none": "", None: ""}),
    (c.rating, {" a+ ": "A+", "NR": None, "E": None}),
    (c.profile_id, {"https://x/us/fl/c/profile/roofing/abc-0733-90573947?x=1": "0733-90573947", "https://x/profile/a/b": None}),
    (c.canonical_url, {"https://x/a/?q=1": "https://x/a", "https://x/a#b": "https://x/a"}),
    (c.strip_tags, {"<b>A &amp; B</b>  c": "A & B c", "<br>": None}),
    (c.slug_title, {"roof-repair_now": "Roof Repair Now"}),
    (lambda v: F.array_join(c.split_urls(v), ";"), {" a | b |a||": "a;b", None: ""}),
    (c.run_id_to_iso, {"2026-09-07T12-33-03Z-full": "2026-09-07T12:33:03Z", "x": None}),
    (c.media_type, {"a.parquet": "application/vnd.apache.parquet", "b": "application/octet-stream"}),
    (c.agency, {" k": "City of Kissimmee", None: None}),
]


@pytest.mark.parametrize("make,cases", CASES, ids=range(len(CASES)))
def test_cases(spark, make, cases):
    assert values(spark, make, *cases) == list(cases.values())


def test_roofing_words(spark):
    rows = [(" rr ", "", True), (None, "Re-Roof shingle", True), (None, "roof mount solar", False), ("Residential Roof", "solar", True), (None, "fire roof", True), (None, "proof of work", False), (None, None, False)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, t string, d string, want boolean")
    assert all(r["got"] == r["want"] for r in df.select("want", c.is_roofing("t", "d").alias("got")).collect())


def test_row_hash_ignores_double_formatting(spark):
    df = spark.createDataFrame([(1, 12345678.0, None)], "a int, b double, c string")
    import hashlib

    assert df.select(c.row_hash(["a", "b", "c"], {"b"})).first()[0] == hashlib.sha256(b"1|12345678.000000|").hexdigest()


def test_haversine_agrees_with_plain_python(spark):
    assert abs(geo.haversine(28.2919, -81.4076, 28.2489, -81.2812) - 8.2) < 0.1
    df = spark.createDataFrame([(28.2489, -81.2812)], "latitude double, longitude double")
    assert abs(df.select(geo.haversine_miles(28.2919, -81.4076)).first()[0] - geo.haversine(28.2919, -81.4076, 28.2489, -81.2812)) < 1e-9


def test_polygon_and_clip(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0)]
    points = [(1.0, 1.0, True), (3.0, 2.0, False), (0.5, 2.0, True), (5.0, 1.0, False), (3.9, 3.9, True), (2.0, 0.5, False)]
    df = spark.createDataFrame([(lat, lng, w) for lat, lng, w in [(1.0, 1.0, True), (3.0, 2.0, False), (2.0, 0.2, True), (1.0, 5.0, False), (0.5, 2.0, True)]], "latitude double, longitude double, want boolean")
    assert all(r["want"] == r["got"] for r in df.select("want", geo.in_polygon(ring).alias("got")).collect())
    assert geo.clip(df, ring).count() == 3 and len(points) == 6


@pytest.mark.parametrize("query,name", [("Kissimmee", "Kissimmee"), ("saint cloud, FL", "St. Cloud"), ("narco", "Narcoossee"), ("BVL", "Buenaventura Lakes"), ("nowhere", None), ("", None), ("Poinciana Florida", "Poinciana")])
def test_gazetteer(spark, query, name):
    found = gazetteer.locate(query)
    assert (found and found[0]) == name
    row = gazetteer.locate_all(spark, spark.createDataFrame([(query,)], "q string"), "q").first()
    assert row["place"] == name


@settings(max_examples=30, deadline=None)
@given(st.floats(27.6, 28.3), st.floats(-81.6, -80.9), st.floats(0.1, 20))
def test_box_holds_its_circle(lat, lng, miles):
    box = geo.box_around(lat, lng, miles)
    for y, x in ((box.max_lat, lng), (box.min_lat, lng), (lat, box.max_lng), (lat, box.min_lng)):
        assert geo.haversine(lat, lng, y, x) >= miles * 0.995
