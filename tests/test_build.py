from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from cadastre import cli
from cadastre.operators import digests
from cadastre.operators.keyed import KeyedTable
from cadastre.plans import build, roll
from cadastre.storage import scratch, stored
from cadastre.streaming import harvest

SF = "/root/testdata/sf0.001"


def loaders(spark, **more):
    return {"roll": lambda asked: roll.raw_roll(spark, SF), "portal": lambda asked: roll.raw_portal(spark, SF), "parcels": lambda asked: roll.parcels(spark, SF), "ratings": lambda asked: roll.profiles(spark, SF)} | more


def test_runs_history_and_recovery(spark, tmp_path):
    day, out = date(2002, 1, 1), f"file://{tmp_path}"
    first = build.execute(spark, loaders(spark), out, run_date=day, run_id="r1")
    assert (first.status, first.mode, first.previousRoot) == ("succeeded", "full", None) and first.tableCounts["properties"] > 0
    assert {s.source: (s.seen > 0, s.inserted > 0, s.changed) for s in first.sources} == {n: (True, True, 0) for n in ("roll", "portal", "parcels", "ratings")}
    permits = spark.read.parquet(str(tmp_path / "r1" / "permits"))
    assert permits.where("source_system = 'osceola_appraiser' AND fetched_at IS NULL").count() == 0

    def broken(asked):
        raise OSError("offline")

    asked_for = []

    def portal(asked):
        """One permit that changed, and one that is new."""
        asked_for.append((asked.mode, asked.window))
        rows = roll.raw_portal(spark, SF).where("fetched_at = '2001-12-31'").orderBy("permit_number").limit(1)
        new = rows.withColumns({"permit_number": F.lit("AC-new"), "fetched_at": F.lit("2002-01-02")})
        return rows.withColumns({"status": F.lit("Withdrawn by owner"), "fetched_at": F.lit("2002-01-02")}).union(new)

    second = build.execute(spark, loaders(spark, ratings=broken, portal=portal), out, run_date=date(2002, 1, 3), run_id="r2")
    assert second.mode == "incremental" and second.previousRoot == first.root and asked_for == [("incremental", (date(2001, 12, 18), date(2002, 1, 3)))]
    told = {s.source: s for s in second.sources}
    assert told["ratings"].status == "failed" and (told["portal"].seen, told["portal"].inserted, told["portal"].changed) == (2, 1, 1)
    assert second.deltas["properties"] == 0 and second.deltas["permits"] == 1
    again = spark.read.parquet(str(tmp_path / "r2" / "permits"))
    assert again.where("bbb_rating IS NOT NULL").count() == permits.where("bbb_rating IS NOT NULL").count()
    assert {r[0] for r in again.where("permit_number = 'AC-new'").select("first_seen_run_id").collect()} == {"r2"}

    with pytest.raises(OSError):
        build.execute(spark, loaders(spark, roll=broken), out, run_date=day, run_id="r3")
    # Two real runs: the parcels of the second have hardly any coordinates.
    bare = lambda asked: roll.parcels(spark, SF).withColumns({n: F.when(F.col("parcel_no") == "P1", F.col(n)) for n in ("latitude", "longitude")})
    with pytest.raises(RuntimeError, match="coverage of latitude fell"):
        build.execute(spark, loaders(spark, parcels=bare), out, mode="full", run_date=day, run_id="r4")
    history = build.History(spark, out)
    assert [r["status"] for r in history.runs()] == ["succeeded", "succeeded", "failed", "failed"] and history.last_published()["runId"] == "r2"
    store = f"file://{tmp_path}/store"
    told = [digests.publish_run(spark, f"{out}/r2", store) for _ in range(2)]
    assert [t["root"] for t in told] == [second.root] * 2 and told[0]["bytes"] > 0 < told[0]["nodes"] and (told[1]["bytes"], told[1]["nodes"]) == (0, 0)
    assert json.loads((tmp_path / "store" / "latest.json").read_text()) == {"root": second.root, "runId": "r2"}


def test_the_roll_is_loaded_once_a_digest(spark, tmp_path, capsys):
    (tmp_path / "in" / "roll").mkdir(parents=True)
    for name, df in roll.raw_roll(spark, SF).items():
        rows = df.collect()
        lines = ["|".join(df.columns), *("|".join("" if v is None else str(v) for v in r) for r in rows)]
        (tmp_path / "in" / "roll" / f"{name}.csv").write_text("\n".join([*lines, "|".join(["x"] * (len(df.columns) + 1))]) + "\n")
    given = ["--input", str(tmp_path / "in"), "--output", f"file://{tmp_path}/out", "--run-date", "2002-01-01"]
    assert cli.main(["run", *given]) == 0
    assert cli.main(["ingest", *given]) == 0
    told = [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    assert [t["status"] for t in told] == ["skipped"]
    assert cli.main(["build", *given[2:]]) == 0 and cli.main(["verify", *given[2:4]]) == 0
    store = ["--store", f"file://{tmp_path}/store"]
    assert cli.main(["publish", *given[2:4], *store]) == 0 and cli.main(["verify", *given[2:4], *store]) == 0
    ledger = json.loads((tmp_path / "out" / "load-ledger.json").read_text())
    assert ledger["roll"]["quarantined"] == len(ledger["roll"]["tables"]) and len(ledger["roll"]["digest"]) == 64
    with pytest.raises(SystemExit):
        cli.main(["ingest", *given, "--source", "portal"])
    first, second = build.History(spark, f"file://{tmp_path}/out").runs()
    assert first["sources"][0]["quarantined"] == len(ledger["roll"]["tables"]) and second["sources"] == [] and second["tableCounts"] == first["tableCounts"]


def test_stream_merges_latest(spark, tmp_path):
    drops, table = tmp_path / "drops", KeyedTable(spark, str(tmp_path / "table"), ["permitNumber"], harvest.latest_fetch())
    drops.mkdir()
    schema = "permitNumber string, status string, fetchedAt string"

    def run():
        harvest.start_merge(harvest.read_drops(spark, str(drops), schema), table, str(tmp_path / "cp")).awaitTermination(60)

    (drops / "a.json").write_text('{"permitNumber":"1","status":"old","fetchedAt":"2026-01-01T00:00:00"}\n{"permitNumber":"2","status":"x","fetchedAt":"2026-01-01T00:00:00"}\n')
    run()
    (drops / "b.json").write_text('{"permitNumber":"1","status":"new","fetchedAt":"2026-01-05T00:00:00"}\n{"permitNumber":"2","status":"late","fetchedAt":"2025-12-01T00:00:00"}\n')
    run()
    assert sorted((r["permitNumber"], r["status"]) for r in table.current().collect()) == [("1", "new"), ("2", "x")]

    # A process that starts anew finds the table as it was, and a batch given twice changes nothing.
    table = KeyedTable(spark, str(tmp_path / "table"), ["permitNumber"], harvest.latest_fetch())
    (drops / "c.json").write_text('{"permitNumber":"3","status":"y","fetchedAt":"2026-01-06T00:00:00"}\n')
    run()
    table.merge(spark.createDataFrame([("3", "z", "2026-01-07T00:00:00")], schema), table.version()[1].batch)
    assert sorted((r["permitNumber"], r["status"]) for r in table.current().collect()) == [("1", "new"), ("2", "x"), ("3", "y")] and len(table.versions()) == 2


def test_stream_windows_and_repeats(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.json").write_text("".join(f'{{"permitNumber":"{k % 2}","status":"s","fetchedAt":"2026-01-0{1 + k}T00:00:00"}}\n' for k in [0, 1, 2, 3, 3]))
    stream = harvest.read_drops(spark, str(tmp_path / "d"), "permitNumber string, status string, fetchedAt string")
    for name, df, mode, n in (("once", harvest.without_repeats(stream, ["permitNumber"]), "append", 4), ("days", harvest.windowed_counts(stream), "complete", 4)):
        query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / name)).start()
        query.awaitTermination(60)
        assert spark.table(name).count() == n


def test_ratings_and_parcels_are_whole_tables(spark):
    sf = "/root/testdata/sf0.01"
    size = lambda n: spark.read.parquet(f"{sf}/{n}.parquet").count()
    assert roll.profiles(spark, sf).count() == size("supplier") > 50
    found = roll.parcels(spark, sf)
    assert found.count() == size("customer") > found.where("latitude IS NOT NULL").count() > 0


class Killed(BaseException):
    """As the end of a process: no handler of the run sees it."""


@pytest.mark.parametrize("end", [Killed, ValueError])
def test_a_run_that_ended_early_is_taken_up(spark, tmp_path, monkeypatch, end):
    asked, staged, links = [], [], build.contractors.links

    def counted(name):
        def load(given):
            asked.append(name)
            return loaders(spark)[name](given)

        return load

    stage = build.permits.stage
    monkeypatch.setattr(build.permits, "stage", lambda *a: (staged.append(1), stage(*a))[1])
    monkeypatch.setattr(build.contractors, "links", lambda rows: (_ for _ in ()).throw(end("down")))
    given = {n: counted(n) for n in ("roll", "portal", "parcels", "ratings")}
    out, day = f"file://{tmp_path}", date(2002, 1, 1)
    with pytest.raises(end):
        build.execute(spark, given, out, run_date=day, run_id="r1")
    monkeypatch.setattr(build.contractors, "links", links)
    assert len(staged) == 1 and sorted(p.name for p in (tmp_path / "steps").glob("*/*")) == ["base", "staged"]
    done = build.execute(spark, given, out, run_date=date(2003, 1, 1), resume=True)
    assert (done.runId, done.runDate, done.status, len(staged)) == ("r1", "2002-01-01", "succeeded", 1) and asked == ["roll", "portal", "parcels", "ratings"]
    assert not list((tmp_path / "steps").glob("*")) and [r["runId"] for r in build.History(spark, out).runs()] == ["r1"]
    assert build.History(spark, out).unfinished() is None
    if end is ValueError:
        return
    whole = build.execute(spark, loaders(spark), f"{out}/other", run_date=day, run_id="r1")
    assert done.tableCounts == whole.tableCounts
    same = ["permit_number", "contractor_id", "row_hash"]
    assert spark.read.parquet(f"{tmp_path}/r1/permits").select(same).exceptAll(spark.read.parquet(f"{tmp_path}/other/r1/permits").select(same)).isEmpty()


def test_a_listing_does_not_replace_a_profile(spark, tmp_path):
    schema = "bbb_id string, name string, raw_html_sha256 string, fetched_at string"
    first = spark.createDataFrame([("1", "full", "h", "2026-01-01"), ("2", "thin", None, None)], schema)
    second = spark.createDataFrame([("1", "bare", None, None), ("2", "full now", "g", "2026-01-02"), ("3", "new", None, None)], schema)
    store = build.RawStore(spark, f"file://{tmp_path}")
    window = (date(2026, 1, 1), date(2026, 1, 2))
    store.keep("ratings", build.Loaded(first), build.Asked("full", window, "r1"))
    result = store.keep("ratings", build.Loaded(second), build.Asked("incremental", window, "r2"))
    assert (result.seen, result.inserted, result.changed) == (3, 1, 2) and store.ledger["ratings"]["tables"] == {"ratings": 3}
    assert {(r["bbb_id"], r["name"]) for r in build.RawStore(spark, f"file://{tmp_path}").read("ratings").collect()} == {("1", "full"), ("2", "full now"), ("3", "new")}


def test_what_others_stored_stays(spark):
    with scratch(spark):
        outer = stored(spark.range(3), "outer")
        with scratch(spark):
            inner = stored(spark.range(4), "inner")
        assert outer.count() == 3
        with pytest.raises(Exception):
            inner.count()
    kept = stored(spark.range(5), "kept")
    with scratch(spark):
        stored(spark.range(6), "own")
    assert kept.count() == 5


def test_no_permit_is_kept_with_its_hashes_or_for_its_contractor(spark):
    kept = {}

    def keep(name, make):
        kept[name] = stored(make(), name)
        return kept[name]

    inputs = build.Inputs(roll.raw_roll(spark, SF), roll.raw_portal(spark, SF), roll.parcels(spark, SF), roll.profiles(spark, SF))
    done = build.build(inputs, "r1", date(2002, 1, 1), keep=keep).permits
    assert not set(kept["staged"].columns) & {"row_hash", "property_id", "property_improvement_id"} and {"aliases", "ratings"} <= set(kept) and "links" not in kept
    assert kept["staged"].count() == done.count() == done.where("row_hash IS NOT NULL").count()
    ways = build.contractors.ways(kept["staged"])
    assert ways.agg({"n": "sum"}).first()[0] == done.where("contractor_id IS NOT NULL").count()
