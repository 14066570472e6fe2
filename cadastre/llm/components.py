"""Connected components of a distributed edge list, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b: long), one label for each component.

    Each round every node moves to its smallest neighbour, smallest in the order of hashed
    ids so that chains shrink as fast as stars, and edges follow. A component has shrunk to one
    node when no edge of it is left. Labels are nodes. Minima are combined before
    they are shuffled, and the joins read stored tables, which Spark may split where a
    node has many edges.
    """
    hashed = edges.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"), F.col("a").alias("a0"), F.col("b").alias("b0"))
    known = materialise(hashed, f"{name}-edges")
    names = known.select(F.col("a").alias("node"), F.col("a0").alias("id")).union(known.select("b", "b0")).distinct()
    now, moves = known.select("a", "b").where("a <> b"), []
    while not now.isEmpty():
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("b"))
        move = materialise(least.select(F.col("a").alias("node"), F.least("a", "b").alias("to")), f"{name}-move")
        moves.append(move)
        first = now.join(move, now.a == move.node).select(F.col("to").alias("a"), "b")
        second = first.join(move, first.b == move.node).select("a", F.col("to").alias("b")).where("a <> b")
        now = materialise(second.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-edges")
    label = names.select("node", "id", F.col("node").alias("label"))
    for move in moves:
        step = move.select(F.col("node").alias("label"), "to")
        label = label.join(step, "label", "left").select("node", "id", F.coalesce("to", "label").alias("label"))
    label = materialise(label, f"{name}-labels")
    back = names.select(F.col("node").alias("label"), F.col("id").alias("label_id"))
    return label.join(back, "label").select(F.col("id").alias("node"), F.col("label_id").alias("label"))
