"""Mixture-controlled packing by deficit round-robin.

Each source is a queue of token ids in stored order, and every window of ``window`` tokens
is filled from all queues in their target proportions. What rounding withholds from a queue
is its deficit, carried into the next window, always under one token: queue q has given
``floor(N * C[q+1] / T) - floor(N * C[q] / T)`` tokens once N are out, where C are cumulative
targets and T is their sum. That closed form is the round-robin's state at any window, so a
partition packs its own documents without waiting for the ones before it.

With the natural mixture all queues end together. Other targets make phases: when a queue
runs dry, the rest share its part in their own proportions. Whatever does not fill a window
at the very end is cut into powers of two, so no sequence is padded.

A window holds no token of a source whose share is under one token a window, so such
sources are one queue together, in stored order: those with a target, whose targets add up, apart
from those without. So the queues are ``window`` with targets and ``window`` without at most,
however many sources there are. A queue whose share falls under one token a window in some phase
shares the slot of the next larger one.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import long_id, materialise, table, text_bytes
from .word_ids import encoder


@dataclass(frozen=True)
class Phase:
    """Tokens ``first`` to ``first + total`` of the output, mixed by ``edges`` (cumulative, by slot).

    Of a queue: its slot, where in the slot it begins, how many tokens it gives in this phase and gave before.
    """

    first: int
    total: int
    edges: list[int]
    slot: dict[str, int]
    lead: dict[str, int]
    takes: dict[str, int]
    begun: dict[str, int]


def slots_of(takes: dict[str, int], window: int) -> list[list[str]]:
    """Queues dealt into slots. One that gives less than a token a window shares the slot of the next larger.

    A slot of a token a window or more never has to take one back when its share is rounded.
    """
    total, slots, small = sum(takes.values()), [], []
    for queue, n in sorted(takes.items(), key=lambda x: (x[1], x[0])):
        small.append(queue)
        if n * window >= total:
            slots.append(small)
            small = []
    if small:
        slots = [*slots[:-1], [*(slots[-1] if slots else []), *small]]
    return slots


def plan(tokens: dict[str, int], weights: dict[str, float] | None, window: int) -> list[Phase]:
    """Phases of the round-robin for queues of so many ``tokens``; weights: the natural mixture if None."""
    left = {q: n for q, n in sorted(tokens.items()) if n}
    share = {q: Fraction(n) if weights is None else Fraction(str(weights.get(q, 0))) for q, n in left.items()}
    done, given, phases = 0, dict.fromkeys(left, 0), []
    while left:
        if not any(share[q] for q in left):
            share = {q: Fraction(n) for q, n in left.items()}
        run = min(left[q] / share[q] for q in left if share[q])
        # The queue that runs dry gives all it has, so every phase ends one.
        takes = {q: n for q in left if (n := min(left[q], int(run * share[q])))}
        slots = slots_of(takes, window)
        edges = [0, *itertools.accumulate(sum(takes[q] for q in members) for members in slots)]
        lead = {q: at for members in slots for q, at in zip(members, itertools.accumulate((takes[q] for q in members), initial=0), strict=False)}
        phases.append(Phase(done, edges[-1], edges, {q: k for k, members in enumerate(slots) for q in members}, lead, takes, {q: given[q] for q in takes}))
        done += edges[-1]
        for q, n in takes.items():
            given[q] += n
            left[q] -= n
        left = {q: n for q, n in left.items() if n}
    return phases


def pieces(phases: list[Phase], queue: str, at: int, length: int, window: int, total: int) -> Iterator[tuple[int, int, int, int]]:
    """(from, length, sequence, offset) of the tokens ``at`` to ``at + length`` of a queue."""
    full = total - total % window
    tails, rest, low = [], total - full, full
    while rest:
        size = 1 << (rest.bit_length() - 1)
        tails.append((low, size))
        low, rest = low + size, rest - size
    for phase in phases:
        if queue not in phase.slot:
            continue
        k, begun, lead = phase.slot[queue], phase.begun[queue], phase.lead[queue]
        below, above = phase.edges[k], phase.edges[k + 1]
        # From here on places in the slot, which begin ``lead`` after the queue's own.
        low, high = max(at, begun) - begun + lead, min(at + length, begun + phase.takes[queue]) - begun + lead
        if low >= high:
            continue

        def given(rounds: int, below: int = below, above: int = above, phase: Phase = phase) -> int:
            n = min(rounds * window, phase.total)
            return n * above // phase.total - n * below // phase.total

        # The round that gives token ``low`` is near its share of the phase; step to it exactly.
        r = low * phase.total // ((above - below) * window)
        while r and given(r) > low:
            r -= 1
        while given(r + 1) <= low:
            r += 1
        while low < high:
            out, new = min(r * window, phase.total), min((r + 1) * window, phase.total)
            stop = min(high, given(r + 1))
            ahead = new * below // phase.total - out * below // phase.total
            place = phase.first + out + ahead + low - given(r)
            first = begun + low - lead - at
            n = stop - low
            while n > 0:
                if place < full:
                    sequence, offset = divmod(place, window)
                    some = min(n, window - offset)
                else:
                    k_tail = next(i for i, (a, size) in enumerate(tails) if place < a + size)
                    sequence, offset = full // window + k_tail, place - tails[k_tail][0]
                    some = min(n, tails[k_tail][1] - offset)
                yield first, some, sequence, offset
                first, place, n = first + some, place + some, n - some
            low, r = stop, r + 1


def tokenise(docs: DataFrame, tokenizer_path: str, end_id: int, name: str, keep_words: bool = True) -> DataFrame:
    """Stored (doc_id, queue, part, within, n_tokens, ids): ``within`` counts the queue's tokens before, in that part."""
    queue = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen, part = encoder(tokenizer_path), {}, TaskContext.get().partitionId()
        end = words.pack([end_id])
        for batch in batches:
            ids = [x + end for x in words.encode(batch.column(2).to_pylist())]
            sizes, within = [len(x) // words.dtype.itemsize for x in ids], []
            for q, n in zip(batch.column(1).to_pylist(), sizes, strict=True):
                within.append(seen.get(q, 0))
                seen[q] = within[-1] + n
            columns = [batch.column(0), batch.column(1), pa.array([part] * len(ids), pa.int32()), pa.array(within, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "source", "part", "within", "n_tokens", "ids"])
        if not keep_words:
            words.forget()

    given = docs.select(long_id(), queue.alias("source"), text_bytes().alias("text"))
    return materialise(given.mapInArrow(run, "doc_id long, source string, part int, within long, n_tokens long, ids binary"), name)


def grouped(sizes: DataFrame, weights: dict[str, float] | None, window: int) -> tuple[DataFrame, dict[str, Fraction] | None]:
    """(source, group) for sources that are queues of their own, all others being in the groups ``+`` and ``#``; targets by group.

    ``sizes`` (source, n). A source is a queue of its own if it has a token a window or more: of all
    tokens, or of the targets of the sources that are there if it has one.
    """
    spark, given = sizes.sparkSession, {k: Fraction(str(v)) for k, v in (weights or {}).items() if v}
    total = sizes.agg(F.sum("n")).first()[0] or 0
    targets = spark.createDataFrame([(k,) for k in given], "source string")
    # No more rows than targets were given.
    there = sorted(r["source"] for r in sizes.join(targets, "source", "left_semi").select("source").distinct().collect())
    mass, named, sums = sum(given[k] for k in there), [], {}
    for k in there:
        group = k if given[k] * window >= mass else "+"
        named.append((k, group))
        sums[group] = sums.get(group, Fraction(0)) + given[k]
    # ``window`` rows at most: each has that part of all tokens.
    large = sizes.groupBy("source").agg(F.sum("n").alias("n")).where(F.col("n") * window >= total).select("source").collect()
    named += [(r["source"], r["source"]) for r in large if r["source"] not in given]
    return spark.createDataFrame(named, "source string, own string"), None if weights is None else sums


def pack(docs: DataFrame, tokenizer_path: str, *, weights: dict[str, float] | None = None, end_id: int = 2, window: int = 4096, keep_words: bool = True) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, doc_tokens, sequence_id, offset, source, ids (uint32 bytes).

    Every id of every document, its end id included, lies in exactly one piece. A null text
    is the end id alone; a null source is a queue of its own; repeated rows are packed as
    often as they stand there; an id is of any integer type; other columns are ignored. ``weights``: source to target share,
    null under the key ``None``; a source without one comes once the others are used up.
    ``keep_words``: whether Python workers keep encoded words from task to task, for speed; not
    where the same workers have other memory-hungry work to do.
    """
    stored = tokenise(docs, tokenizer_path, end_id, "packing", keep_words)
    wanted = None if weights is None else {("null" if k is None else f"={k}"): v for k, v in weights.items()}
    by_part = materialise(stored.groupBy("source", "part").agg(F.sum("n_tokens").alias("n")), "packing-sizes")
    named, targets = grouped(by_part, wanted, window)
    sizes = materialise(by_part.join(F.broadcast(named), "source", "left").select("source", "part", "n", F.coalesce("own", F.lit("#")).alias("group")), "packing-groups")
    tokens = {r["group"]: r["n"] for r in sizes.groupBy("group").agg(F.sum("n").alias("n")).collect()}  # a row a queue
    total = sum(tokens.values())
    phases = plan(tokens, targets, window)
    # What lies before in a queue: its earlier parts, then the sources before in the same part.
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("group", "part").agg(F.sum("n").alias("n")).select("group", "part", F.coalesce(F.sum("n").over(before("group").orderBy("part")), F.lit(0)).alias("earlier"))
    in_part = sizes.withColumn("lead", F.coalesce(F.sum("n").over(before("group", "part").orderBy("source")), F.lit(0)))
    bases = materialise(in_part.join(parts, ["group", "part"]).select("source", "part", "group", (F.col("earlier") + F.col("lead")).alias("base")), "packing-bases")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(tokenizer_path).dtype
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "source", "ids"]
        kinds = [pa.int64()] * 6 + [pa.string(), pa.binary()]
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                rows: list[tuple] = []
                for doc, source, group, base, within, n, raw in zip(*[c.to_pylist() for c in batch.slice(low, 500).columns], strict=True):
                    ids = np.frombuffer(raw, dtype).astype("<u4")
                    label = None if source == "null" else source[1:]
                    for start, length, sequence, offset in pieces(phases, group, base + within, n, window, total):
                        rows.append((doc, start, length, n, sequence, offset, label, ids[start : start + length].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    placed = stored.join(bases, ["source", "part"]).select("doc_id", "source", "group", "base", "within", "n_tokens", "ids")
    return placed.mapInArrow(cut, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, source string, ids binary")


def sequences(packed: DataFrame) -> DataFrame:
    """One row a sequence: sequence_id, length, ids (uint32 bytes), doc_ids of its pieces in order."""
    in_order = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", F.hex("ids").alias("ids"))))
    whole = packed.groupBy("sequence_id").agg(in_order.alias("p"))
    return whole.select("sequence_id", F.aggregate("p.length", F.lit(0).cast("long"), lambda a, x: a + x).alias("length"), F.unhex(F.array_join("p.ids", "")).alias("ids"), F.col("p.doc_id").alias("doc_ids"))


def digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest(pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))
