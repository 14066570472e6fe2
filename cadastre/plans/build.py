"""The batch build: sources to published tables, once or as an increment, with history and recovery rules."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field, replace
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import TABLES
from ..operators import contractors, digests, kpi, permits, places, properties, publish, upsert
from ..operators.keyed import KeyedTable
from ..region import COUNTY, Region
from ..sources.paged import Window, refresh_window
from ..storage import Folder, scratch, stored


@dataclass
class Inputs:
    """Raw tables of one run. What is None was not loaded, and its columns are null in the results."""

    roll: dict[str, DataFrame]
    portal: DataFrame | None = None
    parcels: DataFrame | None = None
    profiles: DataFrame | None = None
    places: DataFrame | None = None


@dataclass
class Tables:
    properties: DataFrame
    permits: DataFrame
    contractors: DataFrame
    places: DataFrame | None

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(n, df) for n in TABLES if (df := getattr(self, n)) is not None]


#: Gives the rows of a named step, made by the function unless they are there already.
Keep = Callable[[str, Callable[[], DataFrame]], DataFrame]


class Steps:
    """Steps of a build in a folder of its output, by a digest of what they are made from.

    A run that is taken up again after a crash reads what was finished and makes the rest.
    """

    def __init__(self, spark: SparkSession, out: str, made_from: object):
        self.spark, self.digest = spark, hashlib.sha256(json.dumps(made_from, sort_keys=True, default=str).encode()).hexdigest()[:16]
        self.folder = Folder(spark, f"{out}/steps")

    def keep(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if not self.folder.exists(self.digest, name, "_SUCCESS"):
            make().write.mode("overwrite").option("compression", "zstd").parquet(self.folder.at(self.digest, name))
        return self.spark.read.parquet(self.folder.at(self.digest, name))

    def drop(self) -> None:
        self.folder.drop(self.digest)


def build(inputs: Inputs, run_id: str, run_date: date, *, previous: dict[str, DataFrame] | None = None, match_unlicensed: bool = False, region: Region = COUNTY, fetched_at: str | None = None, keep: Keep = lambda name, make: stored(make(), name)) -> Tables:
    """All published tables from one run's inputs. ``fetched_at``: when the roll was loaded.

    What several tables are made of is kept as a step: the staged permits without their hashes, the base
    properties, and the published permits, which the properties are summed up from. Contractors are resolved
    over the distinct ways in which permits name them; aliases and ratings are kept so that their size is known.
    """
    previous = previous or {}
    feeds = [permits.from_roll(inputs.roll["permit"], region, fetched_at)]
    if inputs.portal is not None:
        feeds.append(permits.from_portal(inputs.portal, region))
    base = keep("base", lambda: properties.base(inputs.roll, run_date, inputs.parcels, region))
    staged = keep("staged", lambda: permits.stage(feeds, run_date, region).drop(*permits.IDS))
    ways = contractors.ways(staged)
    entities = keep("entities", lambda: contractors.roll_up(contractors.links(ways)))
    ratings = None if inputs.profiles is None else keep("ratings", lambda: contractors.match_ratings(entities, inputs.profiles, match_unlicensed=match_unlicensed))
    published = contractors.publish(entities, ratings)
    alias = keep("aliases", lambda: contractors.aliases(ways))
    done = keep("permits", lambda: permits.publish(staged, base, alias, ratings, inputs.parcels, previous.get("permits"), run_id, region))
    found = properties.publish(base, done, previous.get("properties"), run_id, run_date, region)
    return Tables(found, done, published, None if inputs.places is None else places.publish(inputs.places, published))


@dataclass
class SourceResult:
    source: str
    status: str
    seen: int = 0
    inserted: int = 0
    changed: int = 0
    quarantined: int = 0
    error: str | None = None
    durationMs: int = 0


@dataclass
class Run:
    runId: str
    mode: str
    status: str = "running"
    startedAt: str = ""
    runDate: str = ""
    finishedAt: str | None = None
    root: str | None = None
    previousRoot: str | None = None
    sources: list[SourceResult] = field(default_factory=list)
    tableCounts: dict[str, int] = field(default_factory=dict)
    deltas: dict[str, int] = field(default_factory=dict)
    coverage: dict[str, float] = field(default_factory=dict)


def new_run_id(mode: str, now: datetime | None = None) -> str:
    return f"{(now or datetime.now(UTC)).strftime('%Y-%m-%dT%H-%M-%SZ')}-{mode}"


class History:
    """Run records in one JSON file, by start time; a record replaces the one of its id."""

    NAME = "run-history.json"

    def __init__(self, spark: SparkSession, out: str):
        self.folder = Folder(spark, out)

    def runs(self) -> list[dict]:
        return json.loads(self.folder.read(self.NAME) or "[]")

    def save(self, run: Run) -> None:
        rest = [r for r in self.runs() if r["runId"] != run.runId]
        self.folder.write(json.dumps(sorted([*rest, asdict(run)], key=lambda r: (r["startedAt"], r["runId"])), indent=1), self.NAME)

    def last_published(self) -> dict | None:
        return next((r for r in reversed(self.runs()) if r.get("root")), None)

    def unfinished(self) -> Run | None:
        """The last run, if it did not succeed."""
        last = self.runs()[-1:]
        if not last or last[0]["status"] == "succeeded":
            return None
        return Run(**last[0] | {"sources": [SourceResult(**s) for s in last[0]["sources"]], "finishedAt": None, "status": "running"})


@dataclass
class Loaded:
    """What a loader found. ``digest``: of the source as a whole, if it has one; ``skipped``: it is the one loaded before."""

    tables: DataFrame | dict[str, DataFrame] | None
    digest: str | None = None
    quarantined: int = 0
    skipped: bool = False


@dataclass
class Asked:
    """What a loader is asked for: an increment's window of days (a full run asks for all), and what was loaded last."""

    mode: str
    window: Window
    run_id: str
    last: dict = field(default_factory=dict)


Loader = Callable[[Asked], Loaded | DataFrame | dict[str, DataFrame]]


def by(*columns: str) -> Callable[[list[str]], list[Column]]:
    return lambda have: [F.desc_nulls_last(c) for c in columns if c in have]


def by_page(have: list[str]) -> list[Column]:
    """A profile with an archived page before a bare listing, then the latest."""
    return [*([F.col("raw_html_sha256").isNotNull().desc()] if "raw_html_sha256" in have else []), *by("fetched_at")(have)]


#: Sources whose increments are laid over what is there: their key, which row of an increment counts, and whether it counts whatever is there.
KEYED: dict[str, tuple[list[str], Callable[[list[str]], list[Column]], bool]] = {"portal": (["permit_number"], by("fetched_at"), True), "parcels": (["parcel_no"], by("object_id"), True), "ratings": (["bbb_id"], by_page, False)}


class RawStore:
    """Loaded tables as they are, in ``raw/SOURCE/RUN/TABLE``, and the ledger that says which are current."""

    NAME = "load-ledger.json"

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.folder = spark, Folder(spark, out)
        self.ledger: dict[str, dict] = json.loads(self.folder.read(self.NAME) or "{}")

    def keyed(self, source: str, run_id: str) -> KeyedTable:
        key, order, newest = KEYED[source]
        return KeyedTable(self.spark, self.folder.at("raw", source, run_id), key, order, newest=newest)

    def read(self, source: str) -> DataFrame | dict[str, DataFrame]:
        entry = self.ledger[source]
        if source in KEYED:
            return self.keyed(source, entry["runId"]).current()
        tables = {n: self.spark.read.parquet(self.folder.at("raw", source, entry["runId"], n)) for n in entry["tables"]}
        return tables[source] if list(tables) == [source] else tables

    def keep(self, source: str, got: Loaded, asked: Asked) -> SourceResult:
        """Store what was loaded. An increment of a keyed source is written beside what is there and merged when it is read."""
        if got.skipped:
            return SourceResult(source, "skipped")
        result = SourceResult(source, "ok", quarantined=got.quarantined)
        tables = got.tables if isinstance(got.tables, dict) else {source: got.tables}
        before = self.ledger.get(source)
        run_id, rows = asked.run_id, {}
        if source in KEYED and asked.mode == "incremental" and before is not None:
            run_id, new = before["runId"], stored(tables[source], f"new-{source}")
            table = self.keyed(source, run_id)
            hashed = lambda df: df.withColumn("__hash", F.xxhash64(F.to_json(F.struct(*sorted(new.columns)))))
            counts = upsert.change_counts(hashed(table.current()), hashed(new), KEYED[source][0], "__hash").first()
            result.seen, result.inserted, result.changed = counts["seen"], counts["inserted"], counts["changed"]
            table.merge(new, table.version()[1].batch + 1)
            rows = {source: before["tables"][source] + result.inserted}
        elif source in KEYED:
            self.folder.drop("raw", source, run_id)
            self.keyed(source, run_id).merge(tables[source], 0)
            rows = {source: self.keyed(source, run_id).current().count()}
        else:
            for name, df in tables.items():
                path = self.folder.at("raw", source, run_id, name)
                df.write.mode("overwrite").option("compression", "zstd").parquet(path)
                rows[name] = self.spark.read.parquet(path).count()
        if not result.seen and not result.inserted and run_id == asked.run_id:
            result.seen = result.inserted = sum(rows.values())
        self.ledger[source] = {"digest": got.digest, "runId": run_id, "loadedBy": asked.run_id, "tables": rows, "quarantined": got.quarantined, "loadedAt": datetime.now(UTC).isoformat()}
        self.folder.write(json.dumps(self.ledger, indent=1), self.NAME)
        if before is not None and before["runId"] != run_id:
            self.folder.drop("raw", source, before["runId"])
        return result


def ingest(store: RawStore, loaders: dict[str, Loader], asked: Asked, region: Region = COUNTY) -> Iterator[SourceResult]:
    """Load every source into the raw store. A required one that fails ends it, any other is reported and keeps what it had."""
    for name, loader in loaders.items():
        began = time.monotonic()
        try:
            got = loader(replace(asked, last=store.ledger.get(name, {})))
            result = store.keep(name, got if isinstance(got, Loaded) else Loaded(got), asked)
        except Exception as e:
            result = SourceResult(name, "failed", error=str(e)[:500])
            if region.sources.get(name) and region.sources[name].required:
                yield replace(result, durationMs=int(1000 * (time.monotonic() - began)))
                raise
        yield replace(result, durationMs=int(1000 * (time.monotonic() - began)))


def execute(spark: SparkSession, loaders: dict[str, Loader], out: str, *, mode: str = "incremental", run_date: date, region: Region = COUNTY, run_id: str | None = None, least_coverage: float = 0.5, resume: bool = False) -> Run:
    """Load, build, export and record one run. ``out``: a folder on any file system that all executors reach.

    The run is recorded before anything else, so that a crash shows. A required source that
    fails ends it; any other is recorded, and what it brought before is used again. An increment
    asks its sources for a window since the last published run; without one it is a full run.
    A source that was never loaded leaves its columns null. Coverage of coordinates that falls
    below ``least_coverage`` of the last run's fails the run before it is published.

    ``resume`` takes up the last run if it did not succeed: sources that it loaded are not asked again, and
    steps that it finished are read. Without such a run it is a new one.
    """
    history, store, folder = History(spark, str(out)), RawStore(spark, str(out)), Folder(spark, str(out))
    last, begun = history.last_published(), history.unfinished() if resume else None
    mode = mode if last else "full"
    run = begun or Run(run_id or new_run_id(mode), mode, startedAt=datetime.now(UTC).isoformat(), runDate=run_date.isoformat(), previousRoot=last["root"] if last else None)
    mode, run_date = run.mode, date.fromisoformat(run.runDate)
    run.sources = [s for s in run.sources if s.status != "failed"]
    history.save(run)
    since = date.fromisoformat(last["runDate"]) if last and mode == "incremental" else None
    with scratch(spark):
        try:
            loaded = {s.source for s in run.sources}
            for result in ingest(store, {n: load for n, load in loaders.items() if n not in loaded}, Asked(mode, refresh_window(since, run_date), run.runId), region):
                run.sources.append(result)
                history.save(run)
            have = {n: store.read(n) for n in store.ledger}
            previous = {n: spark.read.parquet(folder.at(last["runId"], n)) for n in ("properties", "permits")} if last else {}
            inputs = Inputs(have["roll"], have.get("portal"), have.get("parcels"), have.get("ratings"), have.get("places"))
            steps = Steps(spark, str(out), [run.runId, run.runDate, run.previousRoot, store.ledger])
            tables = build(inputs, run.runId, run_date, previous=previous, region=region, fetched_at=store.ledger["roll"]["loadedAt"], keep=steps.keep)
            for name, df in tables.items():
                publish.export(df, TABLES[name], folder.at(run.runId, name))
                run.tableCounts[name] = spark.read.parquet(folder.at(run.runId, name)).count()
            run.deltas = {n: c - (last["tableCounts"].get(n, 0) if last else 0) for n, c in run.tableCounts.items()}
            rows = kpi.coverage(spark.read.parquet(folder.at(run.runId, "properties"))).collect()  # a row a column
            run.coverage = {r["column"]: r["pct"] for r in rows}
            before = last["coverage"].get("latitude") if last else None
            if before and (run.coverage.get("latitude") or 0.0) < least_coverage * before:
                raise RuntimeError(f"coverage of latitude fell from {before} to {run.coverage.get('latitude')} %")
            folder.write(json.dumps({"columns": run.coverage, "sources": [asdict(r) for r in run.sources], "ledger": store.ledger}, indent=1), run.runId, "coverage.json")
            files = [r.asDict() for r in digests.digested(spark, folder.at(run.runId)).collect()]  # a row a file
            made = publish.manifest(run.runId, digests.tree(files), run.tableCounts, run.previousRoot)
            folder.write(json.dumps(made, indent=1), run.runId, "manifest.json")
            run.root, run.status = made["root"], "succeeded"
            steps.drop()
        except Exception:
            run.status = "failed"
            raise
        finally:
            run.finishedAt = datetime.now(UTC).isoformat()
            history.save(run)
    return run
