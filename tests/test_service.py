from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from cadastre.functions import formats
from cadastre.operators import api, digests, publish
from cadastre.plans import analogues, build
from cadastre.sources import artifacts, html, portal, ratings
from tests_data import DETAIL, GRID

SF = "/root/testdata/sf0.001"
WEEK = (date(2026, 9, 1), date(2026, 9, 7))


def delta(page: str) -> str:
    units = len(page.encode("utf-16-le")) // 2
    return f"1|#||4|{units}|updatePanel|p|{page}|2|hiddenField|__VIEWSTATE|v2|"


class Portal:
    """Two pages of hits, and detail pages of which one is missing."""

    def __init__(self):
        self.posts, self.busy = [], 1

    def __call__(self, method, url, form):
        if method == "POST":
            self.posts.append(form)
            second = len(self.posts) == 2
            page = GRID.replace("B26-1", "B26-3").replace("capID1=A", "capID1=Z").replace(">2</a>", ">9</a>").replace("Next", "Last") if second else GRID
            return 200, delta(page)
        if url == portal.HOME:
            if self.busy:
                self.busy -= 1
                return 503, ""
            return 200, '<input type="hidden" name="__VIEWSTATE" value="v1">'
        return (404, "") if "capID1=Z" in url else (200, DETAIL)


def test_window_harvest():
    fake = Portal()
    client = portal.Client(fake, wait=0)
    out = portal.harvest_window(client, "Roof", WEEK, "2026-09-08")
    assert [r["permitNumber"] for r in out.records] == ["B26-1"] and out.records[0]["status"] == "Issued" and out.records[0]["openedDate"] == "2026-09-04"
    assert [(f["permitNumber"], f["kind"]) for f in out.failures] == [("B26-3", "permanent")]
    assert (out.summary["searchHits"], out.summary["listOnlyRows"], out.summary["capped"]) == (3, 1, True)
    first, second = fake.posts
    assert first[portal.BUTTON] == "Search" and first["__VIEWSTATE"] == "v1" and first[f"{portal.FIELDS}txtGSStartDate"] == "09/01/2026"
    assert portal.BUTTON not in second and second["__VIEWSTATE"] == "v2" and second["__EVENTTARGET"] == "ctl$2"
    import hashlib

    kept = {"B26-1": (DETAIL, hashlib.sha256(DETAIL.encode()).hexdigest())}
    assert portal.harvest_window(portal.Client(Portal(), wait=0), "Roof", WEEK, "x", archive=kept).summary["detailsSkippedUnchanged"] == 1


def test_lengths_of_an_answer_are_in_utf16_units():
    page = "roof \U0001f3e0 caf\u00e9 | \U0001f44d"
    found = html.parse_delta(delta(page) + "3|hiddenField|__EVENTVALIDATION|\U0001f44dx|")
    assert found["panels"] == {"p": page} and found["hidden"] == {"__VIEWSTATE": "v2", "__EVENTVALIDATION": "\U0001f44dx"} and found["broken"] == ""
    assert html.parse_delta(delta("abc")[:-3])["broken"].startswith("2|hiddenField") and html.parse_delta("")["broken"] == ""
    assert html.parse_delta("9|updatePanel|p|abc|2|hiddenField|v|xy|")["hidden"] == {}


@pytest.mark.parametrize("line,kind", [
    ("KISSIMMEE, FL 34741", "c"), ("KISSIMMEE, FL, 34741-1234", "c"), ("KISSIMMEE,FL 34741", "c"), ("KISSIMMEE, FL34741", "c"), ("KISSIMMEE FL 34741", "l"), ("KISSIMMEE, Fl 34741", "n"), ("KISSIMMEE, FL 347", "n"), ("34741", "s"), ("P.O. Box 7", "s"),
    ("ROOFING CCC1330001", "l"), ("CCC 1330001", "l"), ("GENERAL CBC-12345", "l"), ("ABCDEF1234", "n"), ("X123", "n"), ("SUITE 5", "n"), ("x_CB1234", "n"), ("A 12345678901", "n"), ("12 MAIN ST", "s"), ("JANE", "n"),
])
def test_kinds_of_lines(line, kind):
    assert html.kind_of_line(line) == kind
    assert html.licence_start("ROOFING CCC1330001") == 8 and html.licence_start("") is None and not html.ends_in_city("")


@pytest.mark.parametrize("body", ["<html>", "1|#||4|5|error|e|wrong|", "1|#||4|6|pageRedirect||%2Ferr|", delta(GRID)[:-4]])
def test_protocol_errors(body):
    client = portal.Client(lambda m, u, f: (200, body if m == "POST" else '<input type="hidden" name="__VIEWSTATE" value="1">'))
    with pytest.raises(portal.ProtocolError):
        list(portal.search_pages(client, "Roof", WEEK))


def test_retries_and_percentiles():
    with pytest.raises(portal.HttpError) as e:
        portal.Client(lambda m, u, f: (500, ""), wait=0).get("x")
    assert (e.value.attempts, e.value.transient) == (4, True)
    assert [portal.nearest_rank([3, 1, 2, 4], p) for p in (0, 50, 95)] == [1, 2, 4] and portal.nearest_rank([], 50) == 0


def test_ratings_walk():
    listing = '<a href="/us/x/profile/r/a-0733-9057">A</a><a href="/us/x/profile/r/b-0733-9058">B</a>'

    def page(url):
        if "0733-9058" in url:
            raise OSError("blocked")
        return listing if "search" in url else '<script type="application/ld+json">{"@type":"LocalBusiness","name":"A","telephone":"4075550100"}</script>BBB Rating: A+'

    out = ratings.walk(page, ["K", "S"], ["roofing"], url=lambda c, k, s, n: f"search/{c}/{k}/{s}/{n}")
    assert len(out.listings) == 4 and [p["name"] for p in out.profiles] == ["A"] and out.failures[0]["bbbId"] == "0733-9058"
    assert out.summary["ratingDistribution"] == {"A+": 1} and out.summary["withPhone"] == 1
    assert ratings.walk(page, ["K"], ["r"], url=lambda *a: "search", done=["0733-9057"]).summary["profilesSkippedExisting"] == 1


def test_formats(spark):
    df = spark.createDataFrame([(None, None, None), (999, "2026-09-04", "x" * 40), (123_456, "2026-09-04T10:11:12.5Z", "short"), (-5, "never", "")], "n long, t string, i string")
    out = df.select(formats.whole("n"), formats.delta("n"), formats.size("n"), formats.dollars("n"), formats.day("t"), formats.moment("t"), formats.days_open("n"), formats.short_id("i", 3)).collect()
    assert tuple(out[0]) == ("—",) * 8
    assert tuple(out[1]) == ("999", "+999", "999 B", "$999", "2026-09-04", "2026-09-04 00:00:00Z", "2.7 y (999 d)", "xxx…xxx")
    assert tuple(out[2]) == ("123,456", "+123,456", "121 KB", "$123,456", "2026-09-04", "2026-09-04 10:11:12Z", "338.0 y (123,456 d)", "short")
    assert tuple(out[3]) == ("-5", "-5", "-5 B", "-$5", "never", "never", "-5 d", "—")
    assert [r[0] for r in spark.createDataFrame([(0.0,), (9.96,), (42.4,)], "v double").select(formats.percent("v")).collect()] == ["0%", "10.0%", "42%"]


def test_endpoints(spark):
    service = api.Service(spark, analogues.properties(spark, SF).cache(), analogues.permits(spark, SF).withColumn("improvement_status", F.col("improvement_status")).cache())
    here = {"lat": 28.29, "lng": -81.41, "radiusMiles": 15}
    status, out = service.handle("leads", here | {"minRoofAgeYears": 10, "limit": 5})
    assert status == 200 and len(out["properties"]) == 5 and out["truncated"] and out["total"] > 5
    assert service.handle("open_permits", here)[1]["ratings"]["sentence"].startswith("BBB:")
    assert service.handle("property", {"parcelIdentifier": "P7"})[1]["property"]["parcel_identifier"] == "P7"
    assert service.handle("property", {"parcelIdentifier": "none"})[1] | {"ms": 0} == {"property": None, "permits": [], "ms": 0}
    assert service.handle("query", {"table": "permits", "sql": "SELECT count(*) AS n FROM permits"})[1]["rows"] == [{"n": 1500}]
    assert service.handle("geocode", {"query": "St Cloud"})[1]["place"]["name"] == "St. Cloud"
    assert len(service.handle("area", {"minLat": 28, "maxLat": 28.2, "minLng": -81.5, "maxLng": -81.3})[1]["properties"]) > 0
    assert len(service.handle("area", {"polygon": [[-81.5, 28], [-81.3, 28], [-81.3, 28.2]]})[1]["properties"]) > 0
    assert service.handle("schema", {"table": "places"})[0] == 200
    bad = [("leads", here | {"radiusMiles": 16}), ("leads", {"lat": 28.29}), ("leads", here | {"limit": 1.5}), ("leads", here | {"propertyTypes": ["castle"]}), ("leads", here | {"openRoofPermits": "yes"}), ("leads", here | {"ownerContains": "x" * 121}), ("property", {"parcelIdentifier": "x'"}), ("query", {"table": "x", "sql": "SELECT 1"}), ("query", {"table": "permits", "sql": "DROP TABLE x"}), ("schema", {"table": "x"})]
    assert [service.handle(e, b)[0] for e, b in bad] == [400] * len(bad)
    assert service.handle("nowhere", {})[0] == 404 and service.handle("query", {"table": "permits", "sql": "SELECT nothing FROM permits"})[0] == 500


def test_what_the_assistant_asks(spark):
    service = api.Service(spark, analogues.properties(spark, SF), analogues.permits(spark, SF))
    status, told = service.handle("ask", {"table": "permits", "sql": "SELECT permit_number, contractor_id, contractor_name, bbb_rating, bbb_match_method FROM permits ORDER BY permit_number", "limit": 3})
    assert status == 200 and (told["rowCount"], told["truncated"]) == (3, True) and told["missingCitationColumns"] == ["parcel_identifier", "source_url"] and told["bbbSummary"].startswith("BBB: ")
    assert service.handle("ask", {"table": "properties", "sql": "SELECT 1 AS request_identifier, 2 AS source_urls"})[1]["missingCitationColumns"] == []
    assert service.handle("ask", {"table": "properties", "sql": "SELECT 1 AS x FROM properties WHERE false"})[1]["missingCitationColumns"] == []
    for bad in ({"table": "permits", "sql": "SELECT * FROM properties"}, {"table": "other", "sql": "SELECT 1"}, {"table": "permits", "sql": "SELECT 1", "limit": 201}):
        assert service.handle("ask", bad)[0] == 400


def test_the_service_verifies_a_run(spark, tmp_path):
    (tmp_path / "run").mkdir()
    (tmp_path / "run" / "a.csv").write_text("a")
    files = [r.asDict() for r in digests.digested(spark, f"file://{tmp_path}/run").collect()]
    made = publish.manifest("run", digests.tree(files), {}, None)
    (tmp_path / "run" / "manifest.json").write_text(json.dumps(made))
    stores = {n: f"file://{tmp_path}/{n}" for n in ("one", "two")}
    digests.publish_run(spark, f"file://{tmp_path}/run", stores["one"])
    service = api.Service(spark, analogues.properties(spark, SF), analogues.permits(spark, SF), manifest=made, gateways=stores, pace={"pace": 0.0, "attempts": 2})
    status, told = service.handle("verify", {})
    assert status == 200 and not told["allMatched"] and told["minGateways"] == 2 and {(c["gateway"].rsplit("/", 1)[1], c["ok"]) for c in told["checks"]} == {("one", True), ("two", False)}
    assert service.handle("verify", {"gateways": ["one"]})[1]["allMatched"] and service.handle("verify", {"gateways": ["http://elsewhere"]})[0] == 400


def test_bundles_of_runs(spark, tmp_path):
    found = artifacts.snapshot(spark, f"file://{tmp_path}")
    assert found.runs.count() == 0 and [tuple(r) for r in found.warnings.collect()] == [(None, "run-history.json", "is missing")]
    history = build.History(spark, f"file://{tmp_path}")
    for k, (status, root) in enumerate([("succeeded", "x"), ("succeeded", None), ("failed", None)]):
        history.save(build.Run(f"r{k}", "full", status, startedAt=f"2026-01-0{k + 1}", root=root))
        (tmp_path / f"r{k}").mkdir()
    (tmp_path / "r0" / "manifest.json").write_text('{"runId": "r0", "root": "x"}')
    (tmp_path / "r1" / "manifest.json").write_text("{")
    (tmp_path / "r0" / "coverage.json").write_text('{"columns": {"latitude": 99.5}}')
    (tmp_path / "r2" / "verification.json").write_text('{"runId": "r2"}')
    found = artifacts.snapshot(spark, f"file://{tmp_path}")
    assert found.latest().first()["runId"] == "r2" and found.latest(published=True).first()["runId"] == "r0"
    assert {(r["run_id"], r["document"]) for r in found.warnings.collect()} == {("r1", "manifest.json"), ("r2", "verification.json")}
    assert {r["runId"]: (r["manifest"] is not None, r["coverage"]["columns"] if r["coverage"] else None) for r in found.runs.collect()} == {"r0": (True, {"latitude": 99.5}), "r1": (False, None), "r2": (False, None)}
