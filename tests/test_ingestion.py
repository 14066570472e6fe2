"""Sources that executors read: paged streams, narrowing windows, rejects with their lines, members of archives."""

from __future__ import annotations

import json
import random
import threading
import zipfile
from collections import Counter
from datetime import date
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from pathlib import Path
from urllib.parse import parse_qs, urlsplit

import pytest

from cadastre import cli
from cadastre.sources import archive, delimited, features, windows
from cadastre.sources.paged import bisect
from cadastre.streaming import pages


def test_a_stopped_sweep_goes_on_and_reads_each_page_once(spark, tmp_path):
    seen, broken = tmp_path / "seen", tmp_path / "broken"
    seen.mkdir()
    broken.touch()

    def fetch(offset, size, since):
        if offset >= 50 and broken.exists():
            raise OSError("the service is down")
        (seen / f"{offset}-{random.random()}").touch()
        return [(k, f"{since} {k}") for k in range(offset, offset + size)]

    spark.dataSource.register(pages.page_stream("flaky_pages", "k int, v string", fetch, lambda since: 93, page=10, batch_pages=2, wait=0))
    out, log = f"file://{tmp_path}/out", f"file://{tmp_path}/log"
    with pytest.raises(Exception, match="the service is down"):
        pages.sweep(spark, "flaky_pages", out, log, since="2024")
    assert pages.logged_row(spark, log) == 60
    broken.unlink()
    first = Counter(p.name.split("-")[0] for p in seen.iterdir())
    got = pages.sweep(spark, "flaky_pages", out, log, since="2024")
    assert sorted(tuple(r) for r in got.collect()) == [(k, f"2024 {k}") for k in range(93)]
    again = Counter(p.name.split("-")[0] for p in seen.iterdir())
    # Batches that were committed are not read again; the one that failed is.
    assert {k for k, n in again.items() if n > 1} <= {"40"} and set(first) == {"0", "10", "20", "30", "40"} and set(again) == {str(k) for k in range(0, 93, 10)}
    before = len(list(seen.iterdir()))
    assert pages.sweep(spark, "flaky_pages", out, log, since="2024").count() == 93 and len(list(seen.iterdir())) == before


def test_a_service_that_grows_and_an_empty_one(spark, tmp_path):
    size = tmp_path / "size"
    size.write_text("0")
    spark.dataSource.register(pages.page_stream("growing_pages", "k int", lambda o, n, since: [(k,) for k in range(o, o + n)], lambda since: int(size.read_text()), page=4, wait=0))
    where = f"file://{tmp_path}/out", f"file://{tmp_path}/log"
    for n in (0, 7, 7, 12):
        size.write_text(str(n))
        assert sorted(r["k"] for r in pages.sweep(spark, "growing_pages", *where).collect()) == list(range(n))


def recursive(search, window):
    """The same harvest, one window after the other."""
    hits, capped = search(window)
    halves = bisect(window) if capped else None
    if halves is None:
        return {h[0]: h for h in hits}, [window[0]] if capped else []
    (a, x), (b, y) = (recursive(search, h) for h in halves)
    return a | b, x + y


@pytest.mark.parametrize("last", [date(2026, 1, 1), date(2026, 1, 8), date(2026, 3, 9)])
def test_windows_narrow_until_they_are_whole(spark, last, tmp_path):
    window = (date(2026, 1, 1), last)

    def search(w):
        (tmp_path / f"{w[0]} {w[1]} {random.random()}").touch()
        days = [date.fromordinal(d) for d in range(w[0].toordinal(), w[1].toordinal() + 1)]
        # Some permits are found on several days: the later window's row counts.
        hits = [(f"{d.toordinal() // 3}-{k}", str(d)) for d in days for k in range(7 * d.day % 60 if d.day != 5 else 200)]
        return hits[:100], len(hits) > 100

    spark.dataSource.register(windows.window_source(f"portal_{last:%m%d}", "number string, found string", search, wait=0))
    got = windows.harvest(spark, f"portal_{last:%m%d}", window, ["number"], concurrency=3)
    searched = len(list(tmp_path.iterdir()))
    hits, flagged = recursive(search, window)
    assert {r["number"]: tuple(r) for r in got.hits.collect()} == hits and sorted(r["day"] for r in got.flagged.collect()) == flagged
    assert got.searched.count() == searched and got.rounds <= 1 + (last - window[0]).days.bit_length()


def test_windows_with_a_service_that_fails(spark):
    def search(w):
        raise OSError("no answer")

    spark.dataSource.register(windows.window_source("silent_portal", "number string", search, wait=0))
    with pytest.raises(Exception, match="no answer"):
        windows.harvest(spark, "silent_portal", (date(2026, 1, 1), date(2026, 1, 2)), ["number"])


def test_pages_are_fetched_by_executors(spark, tmp_path):
    def get(url):
        with (tmp_path / "calls").open("a") as f:
            f.write(url + "\n")
        n = (tmp_path / "calls").read_text().splitlines().count(url)
        return {"slow": (200 if n == 3 else 503, "late"), "gone": (404, ""), "down": (500, ""), "page": (200, "body")}[url]

    hits = spark.createDataFrame([(k, u) for k, u in enumerate(["slow", "gone", "down", "page", None])], "k int, url string")
    got = {r["url"]: (r["html"], r["kind"], r["error"]) for r in windows.fetched(hits, "url", get, wait=0).collect()}
    assert got == {"slow": ("late", "ok", None), "gone": (None, "permanent", "status 404 after 1 attempts"), "down": (None, "transient", "status 500 after 4 attempts"), "page": ("body", "ok", None)}
    assert Counter((tmp_path / "calls").read_text().splitlines()) == {"slow": 3, "gone": 1, "down": 4, "page": 1}


def test_rejects_say_where_they_stand(spark, tmp_path):
    draw, want = random.Random(2), set()
    for name in ("a", "b"):
        lines = ["x|y|z"]
        for _ in range(5000):
            n = draw.choice([0, 1, 1, 1, 2, 3, 4] if draw.random() < 0.1 else [2])
            lines.append("|".join(draw.choice(["é" * 20, "", "v"]) for _ in range(n + 1)))
        (tmp_path / f"{name}.csv").write_bytes("\n".join(lines).encode("latin-1") + b"\n")
        want |= {(name, k, t) for k, t in enumerate(lines, 1) if t.count("|") > 2}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4
        got = delimited.rejects(spark, f"file://{tmp_path}/*.csv", columns=["x", "y", "z"]).collect()
        quarantined = delimited.scan(spark, f"file://{tmp_path}/*.csv", columns=["x", "y", "z"]).quarantined.count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {(Path(r["file"]).stem, r["line"], r["text"]) for r in got} == want and len(got) == len(want) == quarantined
    assert {(r["column"], r["reason"]) for r in got} == {(4, "TOO MANY COLUMNS")}


@pytest.mark.parametrize("how", [zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED])
def test_members_of_an_archive(spark, tmp_path, how):
    names = [f"table{k}" for k in range(11)]
    with zipfile.ZipFile(tmp_path / "roll.zip", "w", how) as z:
        for k, name in enumerate(names):
            rows = [f"{k}|{n}" + ("|é" if n % 3 else "") + ("|too|many" if n % 50 == 49 else "") for n in range(300)]
            z.writestr(f"folder/{name.title()}.csv", "\r\n".join(["a|b|c", *rows, ""]).encode("latin-1"))
        z.writestr("deep/er/table0.csv", "no|b|c\n1|2|3")
    uri = f"file://{tmp_path}/roll.zip"
    wanted = [f"{n}.csv" for n in names]
    every = archive.lines(spark, uri, wanted, size=500)
    assert every.rdd.getNumPartitions() >= 11 and every.where("member = 'table3.csv'").count() == 301
    found = archive.scans(spark, uri, wanted, size=500)
    for k in (0, 7):
        rows, wrong = found[f"table{k}.csv"].rows.collect(), found[f"table{k}.csv"].quarantined.collect()
        assert sorted((r["a"], int(r["b"]), r["c"]) for r in rows) == [(str(k), n, "é" if n % 3 else None) for n in range(300) if n % 50 != 49]
        assert len(rows) + len(wrong) == 300 and {r["line"].split("|", 2)[1] for r in wrong} == {str(n) for n in range(300) if n % 50 == 49}
    with pytest.raises(FileNotFoundError, match="other.csv"):
        archive.members(uri, ["other.csv"])


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 100])
def test_ranges_have_each_line_once(size):
    import io

    raw = b"a\n\nbcd\r\nef\n\n\ng"
    whole = [x.rstrip(b"\r") for x in raw.split(b"\n")]
    got = []
    for low in range(0, len(raw), size):
        stream = io.BytesIO(raw)
        stream.seek(max(0, low - 1))
        got += [x for b in archive.line_batches(stream, low, min(low + size, len(raw))) for x in b]
    assert got == whole


class Layer(BaseHTTPRequestHandler):
    """A feature service of 57 parcels; every fifth request fails, and offsets beyond ``limit`` while it is set."""

    asked: list[dict] = []
    limit = None

    def do_GET(self):
        query = {k: v[0] for k, v in parse_qs(urlsplit(self.path).query).items()}
        Layer.asked.append(query)
        since = int(query["where"].split("'")[1][-2:]) if "DATE" in query["where"] else 0
        rows = [k for k in range(57) if k >= since]
        low = int(query.get("resultOffset", 0))
        if len(Layer.asked) % 5 == 0 or (Layer.limit is not None and low > Layer.limit):
            body = {"error": {"code": 500, "message": "busy"}}
        elif "returnCountOnly" in query:
            body = {"count": len(rows)}
        else:
            some = rows[low : low + int(query["resultRecordCount"])]
            body = {"features": [{"attributes": {"OBJECTID_1": k, "PARCELNO": f" P{k // 2} " if k != 9 else " ", "YearBuilt": 1990 if k % 2 else "x", "LastUpdate": 86_400_000 * k, "TotalAcres": k / 2}} | ({"centroid": {"x": -81.0, "y": 28.0}} if k != 11 else {}) for k in some]}
        raw = json.dumps(body).encode()
        self.send_response(200)
        self.send_header("Content-Length", str(len(raw)))
        self.end_headers()
        self.wfile.write(raw)

    def log_message(self, *_):
        pass


def test_a_feature_service_is_swept_over_http(spark, tmp_path):
    server = ThreadingHTTPServer(("127.0.0.1", 0), Layer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url, out = f"http://127.0.0.1:{server.server_port}/layer/0", f"file://{tmp_path}"
    try:
        how = {"run_id": "r1", "run_year": 2026, "fetched_at": "2026-01-01T00:00:00", "page": 5, "batch_pages": 3, "wait": 0}
        Layer.limit = 30
        with pytest.raises(Exception, match="busy"):
            features.sweep(spark, url, out, **how)
        Layer.limit, before = None, len(Layer.asked)
        got = {r["parcel_no"]: (r["object_id"], r["year_built"], str(r["last_update"]), r["acres"]) for r in features.sweep(spark, url, out, **how).collect()}
        again = {int(q["resultOffset"]) for q in Layer.asked[before:] if "resultOffset" in q}
        # The first thirty rows were committed; of two features of a parcel the later one counts, those without a parcel or a centroid are left out.
        assert min(again) == 30 and set(got) == {f"P{k}" for k in range(29)} and got["P4"] == (8, None, "1970-01-09", 4.0) and got["P5"][0] == 10 and got["P1"] == (3, 1990, "1970-01-04", 1.5)
        late = features.sweep(spark, url, out, **how | {"run_id": "r2", "since": "2026-01-20"})
        assert {r["object_id"] for r in late.collect()} == {k for k in range(20, 57) if k % 2 or k == 56}
    finally:
        server.shutdown()


def test_places_are_clipped_from_the_newest_release(spark, tmp_path, monkeypatch):
    called = []
    (tmp_path / "release" / "release=2026-07").mkdir(parents=True)
    (tmp_path / "release" / "release=2026-08").mkdir()
    assert "places" not in cli.loaders(spark, tmp_path, 2026)
    (tmp_path / "boundary.zip").touch()
    monkeypatch.setattr(cli.shapefile, "boundary", lambda *a: called.append(a) or "ring")
    monkeypatch.setattr(cli.places, "cached_extract", lambda *a: called.append(a) or "extract")
    assert cli.loaders(spark, tmp_path, 2026, out="file:/out")["places"](None) == "extract"
    assert called[0][1:] == ("GEOID", "12097") and called[1][1:] == (f"file://{tmp_path}/release", "2026-08", "ring", "12097", "file:/out/extracts")


def test_a_capped_search_holds_a_batch(spark, monkeypatch):
    from cadastre.plans import services

    monkeypatch.setattr(services, "BATCH", 7)
    day = date(2026, 1, 1)
    rows = [((k * 37) % 50, day, str(k % 3)) for k in range(100)]
    served = services.Dated(spark.createDataFrame(rows, "k long, day date, x string"), "day", "served", 5)
    held = []
    plain = services.as_rows
    monkeypatch.setattr(services, "as_rows", lambda batch: held.append(batch.num_rows) or plain(batch))
    assert served.search((day, day)) == (sorted(rows)[:5], True) and max(held) <= 7 < 100
    served.cap = 100
    assert served.search((day, day)) == (sorted(rows), False)
