"""What changed between runs: row lineage, table deltas, and the chain of published snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def carry_lineage(current: DataFrame, previous: DataFrame | None, key: str, run_id: str) -> DataFrame:
    """``current`` (with ``row_hash``) plus first_seen_run_id and last_changed_run_id.

    A row seen before keeps its first run, and its last one too while its hash is the same.
    Rows that only ``previous`` has are gone. ``previous`` is the last published snapshot.
    """
    run = F.lit(run_id)
    if previous is None:
        return current.withColumns({"first_seen_run_id": run, "last_changed_run_id": run})
    before = previous.select(key, F.col("first_seen_run_id").alias("__first"), F.col("last_changed_run_id").alias("__last"), F.col("row_hash").alias("__hash"))
    joined = current.join(before, key, "left")
    same = F.col("__hash") == F.col("row_hash")
    out = joined.withColumns({"first_seen_run_id": F.coalesce("__first", run), "last_changed_run_id": F.when(same, F.col("__last")).otherwise(run)})
    return out.drop("__first", "__last", "__hash")


def table_deltas(current: DataFrame, previous: DataFrame) -> DataFrame:
    """(name, rows, delta) of the tables of ``current``; a table without a past counts from nought."""
    past = previous.select("name", F.col("rows").alias("__rows"))
    return current.join(past, "name", "left").select("name", "rows", (F.col("rows") - F.coalesce("__rows", F.lit(0))).alias("delta"))


def chain_status(runs: DataFrame) -> DataFrame:
    """``runs`` (run_id, started_at, root, previous_root) with ``chain``: first, linked, broken or pending.

    A run links when its previous root is the root of the latest run before it that has one.
    Runs are few, a history of one region, so that one ordered window is enough.
    """
    order = Window.orderBy("started_at", "run_id").rowsBetween(Window.unboundedPreceding, -1)
    prior = F.last("root", ignorenulls=True).over(order)
    status = (
        F.when(prior.isNull(), F.when(F.col("previous_root").isNotNull(), "broken").otherwise("first"))
        .when(F.col("root").isNull() & F.col("previous_root").isNull(), "pending")
        .when(F.col("previous_root") == prior, "linked")
        .otherwise("broken")
    )
    return runs.withColumn("chain", status)


def merge_history(history: DataFrame, record: DataFrame) -> DataFrame:
    """Run records with those of ``record`` in place of the same run_id, by start time."""
    return history.join(record.select("run_id"), "run_id", "left_anti").unionByName(record, allowMissingColumns=True).orderBy("started_at", "run_id")
