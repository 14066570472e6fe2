"""Run documents on disk: read with a schema, and what is wrong with them reported instead of raised."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import Folder

RUN = "runId string, mode string, status string, startedAt string, finishedAt string, rootCid string, previousRootCid string, sources array<struct<source:string,status:string,seen:long,inserted:long,changed:long,quarantined:long,durationMs:long>>, tableCounts map<string,long>"


def read_json(path: str | Path, needed: tuple[str, ...] = ()) -> tuple[dict | None, str | None]:
    """(document, warning): nothing for a missing file, a warning for one that is broken or lacks a field."""
    path = Path(path)
    if not path.exists():
        return None, None
    try:
        found = json.loads(path.read_text())
    except ValueError as e:
        return None, f"{path.name}: {e}"
    missing = [n for n in needed if n not in found]
    return (None, f"{path.name}: lacks {', '.join(missing)}") if missing else (found, None)


def run_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def bundles(folder: str | Path) -> tuple[list[dict], list[str]]:
    """Runs newest first, each with its manifest and coverage if there are any; and warnings."""
    out, warnings = [], []
    for run in sorted((p for p in Path(folder).glob("*") if p.is_dir()), reverse=True):
        bundle = {"runId": run.name}
        for name in ("manifest", "coverage", "verification"):
            bundle[name], warning = read_json(run / f"{name}.json")
            warnings += [f"{run.name}/{warning}"] if warning else []
        out.append(bundle)
    return out, warnings


# Records of runs as the build writes them, and what a bundle reads of each run's documents.
RECORD = "runId string, mode string, status string, startedAt string, runDate string, finishedAt string, root string, previousRoot string, tableCounts map<string,long>"
DOCUMENTS = {"manifest": "runId string, root string, previousRoot string, tableCounts map<string,long>", "coverage": "columns map<string,double>", "verification": "runId string, allMatched boolean"}
NEEDED = {"manifest": "root", "coverage": "columns", "verification": "allMatched"}


@dataclass
class Snapshot:
    """``runs``: every record, newest first by its columns, with its documents; ``warnings``: (run_id, document, problem)."""

    runs: DataFrame
    warnings: DataFrame

    def latest(self, *, published: bool = False) -> DataFrame:
        """The newest run; or the newest that succeeded and has a root."""
        rows = self.runs.where("status = 'succeeded' AND root IS NOT NULL") if published else self.runs
        return rows.orderBy(F.desc("startedAt"), F.desc("runId")).limit(1)


def snapshot(spark: SparkSession, out: str) -> Snapshot:
    """Records of all runs joined with the documents in their folders. A missing document is null, a broken one is null and a warning; nothing raises."""
    folder = Folder(spark, out)
    history = folder.read("run-history.json")
    records = spark.createDataFrame([(history or "[]",)], "value string").select(F.explode(F.from_json("value", f"array<struct<{RECORD}>>")).alias("r")).select("r.*")
    runs, found = records, None
    for name, schema in DOCUMENTS.items():
        # A name a run, listed once.
        paths = [folder.at(n, f"{name}.json") for n in folder.names() if folder.exists(n, f"{name}.json")]
        texts = spark.read.text(paths, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("runId"), "value") if paths else spark.createDataFrame([], "runId string, value string")
        read = texts.select("runId", F.from_json("value", schema).alias("document"))
        whole = F.col(f"document.{NEEDED[name]}").isNotNull()
        problems = read.where(~whole).select(F.col("runId").alias("run_id"), F.lit(f"{name}.json").alias("document"), F.lit(f"is broken or lacks {NEEDED[name]}").alias("problem"))
        found = problems if found is None else found.union(problems)
        runs = runs.join(read.where(whole).select("runId", F.col("document").alias(name)), "runId", "left")
    if history is None:
        found = found.union(spark.createDataFrame([(None, "run-history.json", "is missing")], found.schema))
    return Snapshot(runs, found)
