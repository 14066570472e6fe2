from __future__ import annotations

import io
import json
import shutil
import struct
import zipfile
from datetime import date

import pytest

from cadastre.operators import places
from cadastre.sources import artifacts, delimited, harvests, html, paged, shapefile
from tests_data import DETAIL, GRID


def test_raw_scan_keeps_short_rows_and_quarantines_long_ones(spark, tmp_path):
    path = tmp_path / "permit.csv"
    path.write_bytes("a|b|c\n1|2|3\n4|5\n6|7|8|9\n\"x|José|\n".encode("latin-1"))
    found = delimited.scan(spark, str(path))
    assert sorted((r["a"], r["b"], r["c"]) for r in found.rows.collect()) == sorted([("1", "2", "3"), ("4", "5", None), ('"x', "José", None)])
    assert [r["line"] for r in found.quarantined.collect()] == ["6|7|8|9"]


def test_roll_load_is_idempotent(spark, tmp_path):
    (tmp_path / "a.csv").write_text("strap|x\n1|2\n")
    files = {"parcel": str(tmp_path / "a.csv")}
    done = delimited.load_roll(spark, files, digest="d", loaded={}, tax_year=2026, run_id="r")
    assert (done.status, done.seen, done.quarantined) == ("loaded", 1, 0) and done.tables["parcel"].columns[-1] == "loaded_run_id"
    assert delimited.load_roll(spark, files, digest="d", loaded={2026: "d"}, tax_year=2026, run_id="r").status == "skipped"
    assert delimited.load_roll(spark, files, digest="d", loaded={2026: "d"}, tax_year=2026, run_id="r", force=True).status == "loaded"


def test_archive_member(tmp_path):
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("folder/Parcel.csv", "x")
    assert delimited.extract_member(tmp_path / "z.zip", "parcel.csv", tmp_path).read_text() == "x"
    with pytest.raises(FileNotFoundError):
        delimited.extract_member(tmp_path / "z.zip", "other.csv", tmp_path)
    assert len(delimited.sha256_of(tmp_path / "z.zip")) == 64


def test_harvest_lines(spark, tmp_path):
    lines = [{"permitNumber": "1", "fetchedAt": "2026-01-01", "status": "old"}, {"permitNumber": "1", "fetchedAt": "2026-02-01", "status": "new", "contractor": {"name": "J"}}, {"permitNumber": None}]
    (tmp_path / "p-1.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\n{broken\n")
    assert harvests.files_of(tmp_path, "p") == [str(tmp_path / "p-1.jsonl")]
    got = harvests.portal_permits(harvests.read_lines(spark, harvests.files_of(tmp_path, "p"), harvests.PERMIT)).collect()
    assert [(r["permit_number"], r["status"], r["contractor_name"]) for r in got] == [("1", "new", "J")]
    (tmp_path / "p.jsonl").write_text("")
    assert harvests.files_of(tmp_path, "p") == [str(tmp_path / "p.jsonl")]


def test_profiles_prefer_full_pages(spark):
    full = spark.createDataFrame([("1", "Full", ["CCC1"], "2026-01-01", "sha")], "bbbId string, name string, licenseNumbers array<string>, fetchedAt string, rawHtmlSha256 string")
    for n, t in (("rating", "string"), ("accredited", "boolean"), ("ratingScore", "double"), ("reviewCount", "int"), ("complaintCount", "int"), ("phone", "string"), ("profileUrl", "string"), ("city", "string"), ("state", "string"), ("zip", "string"), ("categories", "array<string>")):
        full = full.selectExpr("*", f"CAST(NULL AS {t}) AS {n}")
    thin = spark.createDataFrame([("1", "Thin", ["4"]), ("2", "Other", ["5", "6"])], "bbbId string, name string, phones array<string>")
    for n, t in (("rating", "string"), ("accredited", "boolean"), ("ratingScore", "double"), ("city", "string"), ("state", "string"), ("postalCode", "string"), ("categories", "array<string>"), ("profileUrl", "string")):
        thin = thin.selectExpr("*", f"CAST(NULL AS {t}) AS {n}")
    got = {r["bbb_id"]: (r["name"], r["phone"], r["license_numbers"]) for r in harvests.profiles(full, thin).collect()}
    assert got == {"1": ("Full", None, ["CCC1"]), "2": ("Other", "5", [])}


def test_features(spark):
    data = [(1, "P1", 28.0, -81.0, 1999, 0), (2, " ", 28.0, -81.0, 1999, 0), (3, "P3", None, -81.0, 1999, 0), (4, "P4", 28.0, -81.0, 1600, 86_400_000)]
    df = spark.createDataFrame(data, "OBJECTID int, ParcelNo string, y double, x double, YearBuilt int, LastUpdate long")
    assert [(r["objectId"], r["yearBuilt"], r["lastUpdate"]) for r in harvests.features(df, 2026).orderBy("objectId").collect()] == [(1, 1999, "1970-01-01"), (4, None, "1970-01-02")]


def test_paged_source(spark):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)

    def fetch(offset, size, since):
        return [(k + (since or 0), f"row {k} of {since}") for k in range(offset, offset + size)]

    spark.dataSource.register(paged.paged_source("county_pages", "k int, v string", fetch, lambda since: 4500 - (since or 0), since_column="k"))
    df = spark.read.format("county_pages").load()
    assert df.count() == 4500 and df.rdd.getNumPartitions() == 3
    late = df.where("k >= 4000 AND v LIKE 'row 1%'")
    assert {r["v"].split(" of ")[1] for r in late.collect()} == {"4000"} and late.count() == 111


def test_small_files(tmp_path):
    assert paged.smallest({"a": 0, "c": 5, "b": 5}) == "b" and paged.smallest({}) is None
    tries = []

    def open_url(url):
        tries.append(url)
        if len(tries) == 1:
            raise OSError("once")
        return io.BytesIO(b"x" * 3_000_000)

    assert paged.download(open_url, "u", tmp_path / "f.zip", wait=0).stat().st_size == 3_000_000 and len(tries) == 2
    with pytest.raises(OSError):
        paged.download(lambda u: (_ for _ in ()).throw(OSError("gone")), "u", tmp_path / "g.zip", wait=0)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["f.zip"]


def shape_zip(path, rings, names):
    body = b""
    for k, ring in enumerate(rings):
        points = b"".join(struct.pack("<2d", *p) for p in ring)
        shape = struct.pack("<i4d2ii", 5, 0, 0, 0, 0, 1, len(ring), 0) + points
        body += struct.pack(">2i", k + 1, len(shape) // 2) + shape
    field = b"GEOID".ljust(11, b"\0") + b"C" + bytes(4) + bytes([8]) + bytes(15)
    rows = b"".join(b" " + n.encode().ljust(8) for n in names)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("county/tl.shp", bytes(100) + body)
        z.writestr("county/tl.dbf", struct.pack("<4BIHH", 3, 0, 0, 0, len(names), 65, 9) + bytes(20) + field + b"\r" + rows)


def test_places_of_a_release(spark, tmp_path):
    ring = [(-81.7, 27.5), (-80.8, 27.5), (-80.8, 28.4), (-81.7, 28.4), (-81.7, 27.5)]
    shape_zip(tmp_path / "b.zip", [[(0, 0), (1, 0), (1, 1), (0, 0)], ring], ["12001", "12097"])
    found = shapefile.boundary(tmp_path / "b.zip", "GEOID", "12097")
    assert found == ring and len(shapefile.read_zip(tmp_path / "b.zip")) == 2
    with pytest.raises(ValueError, match="no shape"):
        shapefile.boundary(tmp_path / "b.zip", "GEOID", "0")
    schema = (
        "id string, names struct<primary:string>, taxonomy struct<primary:string,hierarchy:array<string>,alternates:array<string>>, basic_category string, operating_status string, confidence double, websites array<string>, phones array<string>, "
        "emails array<string>, brand struct<names:struct<primary:string>>, addresses array<struct<freeform:string,locality:string,postcode:string,region:string>>, sources array<struct<dataset:string>>, bbox struct<xmin:float,xmax:float,ymin:float,ymax:float>"
    )
    row = lambda k, x, y: (k, ("n",), ("t", ["a", "b"], None), "c", "open", 0.9, None, ["407"], None, None, [("1 A ST", "K", "34741", "FL")], [("meta",)], (x, x, y, y))
    spark.createDataFrame([row("in", -81.4, 28.0), row("out", -70.0, 28.0)], schema).write.parquet(str(tmp_path / "release=r1" / "theme=places" / "type=place"))
    scanned = places.read_release(spark, str(tmp_path), "r1", found)
    assert "PushedFilters: [" in (plan := scanned._jdf.queryExecution().executedPlan().toString()) and "GreaterThanOrEqual(bbox.xmin" in plan
    for _ in range(2):
        got = places.cached_extract(spark, str(tmp_path), "r1", found, "12097", str(tmp_path / "cache")).collect()
        assert [(r["gers_id"], r["taxonomy_hierarchy"], r["county_fips"]) for r in got] == [("in", "a/b", "12097")]
        shutil.rmtree(tmp_path / "release=r1", ignore_errors=True)


def test_professional_blocks():
    def told(*lines):
        return html.professional(html.parse("<td>" + "<br>".join(lines) + "</td>").children[0])[0]

    full = told("JANE DOE", "ABC ROOFING", "OF ORLANDO", "12 MAIN ST", "SUITE 5", "KISSIMMEE, FL, 34741", "ROOFING CCC1330001")
    assert (full["businessName"], full["address"], full["licenseNumber"], full["licenseType"]) == ("ABC ROOFING OF ORLANDO", "12 MAIN ST, SUITE 5, KISSIMMEE, FL, 34741", "CCC1330001", "ROOFING")
    box = told("JOE", "P.O. Box 7", "ORLANDO FL", "ORLANDO, FL 32801-1234")
    assert (box["businessName"], box["address"], box["licenseNumber"]) == (None, "P.O. Box 7, ORLANDO FL, ORLANDO, FL 32801-1234", None)
    bare = told("JOE", "ABC INC", "somewhere", "CBC-12345")
    assert (bare["businessName"], bare["address"], bare["licenseNumber"], bare["licenseType"]) == ("ABC INC", "somewhere", "CBC12345", None)
    assert told("ONE")["name"] == "ONE" and told()["name"] is None and told("JOE", "ABC", "KISSIMMEE, FL 34741")["address"] == "KISSIMMEE, FL 34741"


def test_failed_pages_are_rows(spark):
    df = spark.createDataFrame([("u1", "<p>", 1), ("u2", "bad", 2)], "url string, html string, page_id int")

    def parser(page, url):
        if page == "bad":
            raise ValueError("broken")
        return [{"n": 1}]

    got = {tuple(r) for r in html.parse_pages(df, parser, "n int", keep=["page_id"]).collect()}
    assert got == {(1, 1, None), (2, None, "broken")}


def test_windows():
    whole = (date(2026, 1, 1), date(2026, 1, 8))

    assert paged.bisect((whole[0], whole[0])) is None
    assert paged.refresh_window(None, date(2026, 4, 1))[0] == date(2026, 1, 1)
    assert paged.refresh_window(date(2026, 3, 30), date(2026, 4, 1))[0] == date(2026, 3, 16)


def test_search_page():
    page = html.parse_results(GRID)
    assert [(r["permitNumber"], r["date"], r["recordType"]) for r in page["rows"]] == [("B26-1", "2026-09-04", "Roof & gutter"), ("B26-2", None, None)]
    assert page["rows"][0]["capId"] == {"capID1": "A", "capID2": "B", "capID3": "C"} and page["rows"][0]["recordId"] == "R1"
    assert (page["total"], page["capped"], page["showing"], page["nextPageTarget"], page["pageCount"]) == (100, True, (1, 2), "ctl$2", 3)
    body = f"1|#||4|{len(GRID)}|updatePanel|p|{GRID}|2|hiddenField|__VIEWSTATE|ab|9|pageRedirect||%2Ferr%20|"
    assert html.is_delta(body) and html.parse_delta(body)["hidden"] == {"__VIEWSTATE": "ab"} and html.parse_delta(body)["redirect"] == "/err "
    assert len(html.parse_results(body)["rows"]) == 2
    assert html.parse_results("<p>Your search returned no results.</p>")["total"] == 0
    assert html.hidden_fields('<input type="hidden" name="a" value="1"><input type=hidden name=b>') == {"a": "1", "b": ""}


def test_detail_page():
    record, extra = html.parse_detail(DETAIL, "https://p/CapDetail.aspx?capID1=A&capID2=B&capID3=C")
    assert record["jobValue"] == 22599.0 and record["parcelNumber"] == "252628610005220080" and record["openedDate"] == "2026-09-04"
    assert record["description"] == "re-roof shingle" and extra["contractor.email"] == "jane@x.com"
    assert record["contractor"] == {"name": "JANE DOE", "businessName": "ABC ROOFING LLC", "licenseNumber": "CCC1330001", "licenseType": "ROOFING", "phone": "4075550100", "address": "12 MAIN ST, SUITE 5, KISSIMMEE, FL, 34741"}
    with pytest.raises(ValueError, match="number"):
        html.parse_detail("<p>", "https://p/?capID1=A&capID2=B&capID3=C")


def test_listing_and_profile():
    item = {"reportUrl": "/us/fl/x/profile/roofing/abc-0733-90573947?s=1", "businessName": "<em>ABC</em> &amp; Co", "rating": "A +", "bbbMember": True, "phone": ["1"], "categories": [{"name": "Roofing"}], "ratingScore": 97.5}
    state = {"searchResult": {"results": [item, item, {"reportUrl": "bad"}], "page": 1, "totalPages": 2}}
    page = html.parse_listing(f"<script>window.__PRELOADED_STATE__ = {json.dumps(state)}; var x = '}}';</script>")
    assert [(r["bbbId"], r["name"], r["rating"]) for r in page["results"]] == [("0733-90573947", "ABC & Co", "A+")] and page["hasNext"]
    dom = html.parse_listing('<a href="/us/x/profile/r/a-0733-9057"><img></a><a href="/us/x/profile/r/a-0733-9057">A</a><a href="?page=3">3</a>')
    assert [r["name"] for r in dom["results"]] == ["A"] and dom["hasNext"]
    url = "https://www.bbb.org/us/fl/x/profile/roofing/abc-0733-90573947"
    profile = {"businessProfile": {"names": {"primary": "ABC"}, "rating": {"bbbRating": "A+"}, "contactInformation": {"phoneNumber": "(407) 555-0100"}, "orgDetails": {"license": {"details": [{"licenseNumber": "CCC-1330001", "notes": "also CBC 12345"}]}}, "reviewsComplaintsSummary": {"reviewsTotal": "12"}}}
    found = html.parse_profile(f"<script>window.__PRELOADED_STATE__ = {json.dumps(profile)};</script>", url)
    assert (found["phone"], found["licenseNumbers"], found["reviewCount"]) == ("4075550100", ["CCC1330001", "CBC12345"], 12)
    bare = html.parse_profile('<script type="application/ld+json">{"@type":"LocalBusiness","name":"ABC","telephone":"4075550100"}</script><body>BBB Rating: A- License: CCC1330001</body>', url)
    assert (bare["name"], bare["rating"], bare["licenseNumbers"]) == ("ABC", "A-", ["CCC1330001"])
    with pytest.raises(ValueError):
        html.parse_profile("<p>x</p>", url)
    assert html.is_challenge("<title>Just a moment...</title>") and not html.is_challenge("<title>ABC</title>")


def test_pages_in_spark(spark):
    df = spark.createDataFrame([("u1", "<title>T</title><h1>a</h1><a href='/x'>l</a>"), ("u2", None)], "url string, html string")
    got = {r["url"]: (r["title"], r["links"]) for r in html.parse_pages(df, html.page_outline, "url string, title string, headings int, links int, characters int").collect()}
    assert got == {"u1": ("T", 1), "u2": (None, 0)}


def test_references_without_their_semicolon_are_text():
    read = lambda page: html.page_outline(page, "u")[0]
    assert read("<title>a &amp; b&amp</title>")["title"] == "a & b&amp" and read("<title>a&am</title>")["title"] == "a&am"
    assert read("&lt;p&gt; &#65;&#x42; &copy &nosuch; &")["characters"] == len("<p> AB &copy &nosuch; &")
    assert read('<a href="/x?a=1&copy=2">l</a>')["links"] == 1


def test_documents_on_disk(tmp_path):
    (tmp_path / "2026").mkdir()
    (tmp_path / "2026" / "manifest.json").write_text("{")
    runs, warnings = artifacts.bundles(tmp_path)
    assert runs[0]["manifest"] is None and "manifest.json" in warnings[0]
    (tmp_path / "x.json").write_text('{"a": 1}')
    assert artifacts.read_json(tmp_path / "x.json", ("b",))[1] == "x.json: lacks b" and artifacts.read_json(tmp_path / "none.json") == (None, None)
