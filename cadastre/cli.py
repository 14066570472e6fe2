"""Command line: python -m cadastre.cli COMMAND."""

from __future__ import annotations

import argparse
import hashlib
import json
from datetime import UTC, date, datetime
from pathlib import Path

from pyspark.sql import SparkSession

from .contracts import TABLES, describe
from .operators import digests, guard, places, verify
from .plans import build
from .region import COUNTY
from .sources import archive, delimited, features, harvests, shapefile
from .sources.paged import refresh_window
from .storage import Folder


def loaders(spark: SparkSession, folder: Path, tax_year: int, force: bool = False, *, out: str | None = None, parcels_url: str | None = None) -> dict[str, build.Loader]:
    """Loaders of what a folder holds: roll/*.csv or roll/*.zip, portal*.jsonl, parcels*.jsonl, profiles*.jsonl, listings*.jsonl, places/*.parquet.

    Also release/release=R of places with boundary.zip, the county's outline: the newest release is clipped once and kept under ``out``.
    ``parcels_url``: a feature service to sweep instead of reading parcel files; a run that is taken up again goes on where its sweep stopped.
    The roll is loaded once a digest of its files. An increment takes the portal's records fetched within its window, and
    of the service what changed since.
    """

    def roll(asked: build.Asked) -> build.Loaded:
        files, archives = sorted((folder / "roll").glob("*.csv")), sorted((folder / "roll").glob("*.zip"))
        whole = hashlib.sha256("".join(f"{p.name}:{delimited.sha256_of(p)}" for p in [*files, *archives]).encode()).hexdigest()
        done = {tax_year: asked.last["digest"]} if asked.last else {}
        scans = {p.stem.lower(): lambda p=p: delimited.scan(spark, str(p)) for p in files}
        for path in archives:
            uri = path.absolute().as_uri()
            scans |= {n.removesuffix(".csv"): lambda n=n, uri=uri: archive.scans(spark, uri, [n])[n] for n in archive.members(uri) if n.endswith(".csv")}
        got = delimited.load_scans(scans, digest=whole, loaded=done, tax_year=tax_year, run_id=asked.run_id, force=force)
        return build.Loaded(None if got.status == "skipped" else dict(got.tables), whole, got.quarantined, got.status == "skipped")

    found: dict[str, build.Loader] = {"roll": roll}
    if parcels_url:

        def parcels(asked: build.Asked):
            since = asked.window[0].isoformat() if asked.mode == "incremental" else None
            return features.sweep(spark, parcels_url, out, run_id=asked.run_id, run_year=tax_year, fetched_at=datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%S"), since=since)

        found["parcels"] = parcels
    elif paths := harvests.files_of(folder, "parcels"):
        found["parcels"] = lambda asked, paths=paths: harvests.parcels(harvests.read_lines(spark, paths, harvests.PARCEL))
    if paths := harvests.files_of(folder, "portal"):

        def portal(asked: build.Asked, paths: list[str] = paths):
            rows = harvests.portal_permits(harvests.read_lines(spark, paths, harvests.PERMIT))
            return rows if asked.mode == "full" else rows.where(rows.fetched_at.try_cast("date") >= asked.window[0])

        found["portal"] = portal
    full, thin = harvests.files_of(folder, "profiles"), harvests.files_of(folder, "listings")
    if full or thin:
        empty = lambda schema: spark.createDataFrame([], schema)
        found["ratings"] = lambda asked: harvests.profiles(harvests.read_lines(spark, full, harvests.PROFILE) if full else empty(harvests.PROFILE), harvests.read_lines(spark, thin, harvests.LISTING) if thin else empty(harvests.LISTING))
    if (folder / "places").is_dir():
        found["places"] = lambda asked: spark.read.parquet(str(folder / "places"))
    releases = sorted(p.name.removeprefix("release=") for p in (folder / "release").glob("release=*"))
    if releases and (folder / "boundary.zip").exists():

        def clipped(asked: build.Asked):
            ring = shapefile.boundary(folder / "boundary.zip", "GEOID", COUNTY.fips)
            return places.cached_extract(spark, (folder / "release").absolute().as_uri(), releases[-1], ring, COUNTY.fips, f"{out or folder.absolute().as_uri()}/extracts")

        found["places"] = clipped
    return found


def chosen(found: dict[str, build.Loader], names: list[str] | None) -> dict[str, build.Loader]:
    if unknown := set(names or ()) - set(found):
        raise SystemExit(f"no such source here: {', '.join(sorted(unknown))}")
    return {n: load for n, load in found.items() if not names or n in names}


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="cadastre")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, about: str, *, reads: bool = False, dated: bool = False) -> argparse.ArgumentParser:
        made = commands.add_parser(name, help=about)
        made.add_argument("--output", required=name != "tables")
        if reads:
            made.add_argument("--input", type=Path, required=True)
            made.add_argument("--force", action="store_true", help="load the roll even if its digest is loaded")
        if dated:
            made.add_argument("--mode", choices=["full", "incremental"], default="incremental")
            made.add_argument("--run-date", type=date.fromisoformat, default=date.today())
            made.add_argument("--resume", action="store_true", help="take up the last run if it did not succeed")
        if reads:
            made.add_argument("--parcels-url", help="a feature service to sweep for parcels")
            made.add_argument("--source", action="append", help="load this source alone; may be given again")
        return made

    command("run", "load, build, export and record one run", reads=True, dated=True)
    command("ingest", "load sources into the raw store alone", reads=True, dated=True)
    command("build", "build, export and record one run from the raw store", dated=True)
    command("publish", "the last run's files into a store by content").add_argument("--store", required=True)
    command("history", "all runs")
    command("tables", "the published columns")
    command("query", "one SELECT over the last published tables").add_argument("statement")
    checks = command("verify", "compare the last run's files with its manifest, or with what stores give")
    checks.add_argument("--store", action="append", help="a store to fetch from; may be given again")
    checks.add_argument("--least", type=int, default=verify.LEAST, help="stores that must agree")
    given = parser.parse_args(args)
    if given.command == "tables":
        print(json.dumps({n: describe(n) for n in TABLES}, indent=1))
        return 0
    spark = SparkSession.builder.appName("cadastre").getOrCreate()
    history = build.History(spark, given.output)
    if given.command == "history":
        print(json.dumps(history.runs(), indent=1))
        return 0
    if given.command in ("run", "build"):
        sources = chosen(loaders(spark, given.input, given.run_date.year, given.force, out=given.output, parcels_url=given.parcels_url), given.source) if given.command == "run" else {}
        print(build.execute(spark, sources, given.output, mode=given.mode, run_date=given.run_date, resume=given.resume).status)
        return 0
    last = history.last_published()
    if given.command == "ingest":
        since = date.fromisoformat(last["runDate"]) if last and given.mode == "incremental" else None
        asked = build.Asked(given.mode if since else "full", refresh_window(since, given.run_date), datetime.now(UTC).strftime("%Y-%m-%dT%H-%M-%SZ"))
        for result in build.ingest(build.RawStore(spark, given.output), chosen(loaders(spark, given.input, given.run_date.year, given.force, out=given.output, parcels_url=given.parcels_url), given.source), asked):
            print(json.dumps(vars(result)))
        return 0
    if last is None:
        print("nothing is published")
        return 1
    folder = Folder(spark, given.output + "/" + last["runId"])
    if given.command == "query":
        tables = {n: spark.read.parquet(folder.at(n)) for n in TABLES if folder.exists(n)}
        guard.run_select(spark, given.statement, tables).show(50, truncate=False)
        return 0
    if given.command == "publish":
        print(json.dumps(digests.publish_run(spark, folder.root, given.store)))
        return 0
    made = json.loads(folder.read("manifest.json"))
    if given.store:
        report = verify.verify(spark, made, given.store, verify.from_stores, least=given.least)
        report.checks.select("artifact", "gateway", "ok", "attempts", "error").orderBy("artifact", "gateway").show(200, truncate=False)
        print("verified" if report.all_matched else "not verified")
        return int(not report.all_matched)
    listed = {a["name"]: a["sha256"] for a in made["artifacts"] if a["codec"] == "file"}
    now = {r["name"]: r["sha256"] for r in digests.digested(spark, folder.root).collect()}
    wrong = sorted(n for n in listed.keys() | now.keys() if listed.get(n) != now.get(n))
    print("\n".join(f"differs: {n}" for n in wrong) or "all match")
    return int(bool(wrong))


if __name__ == "__main__":
    raise SystemExit(main())
