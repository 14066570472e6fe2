"""Benchmark decontamination by a generalised suffix automaton.

All items, as word numbers, go into one automaton whose states stand for the distinct
word sequences inside items. A document's words are streamed through it; after each word
the automaton holds the longest run of latest words that some item contains. Where that
run reaches a window's length, its last words are an occurrence of a window, and the state
that owns the window tells which items it belongs to.

Items are taken in blocks of bounded size, each block with its own automaton, and texts go
through them one after another; hits are united.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, raw_texts, sliced, table, text_bytes

#: Fixed value of the contract, over UTF-8 bytes with A-Z lowered.
find_words = re.compile(rb"[0-9a-z\x80-\xff]+").findall
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Words of benchmark items in one automaton (about 100 MB), and automata that a stage runs texts through.
BLOCK_WORDS, STAGE_BLOCKS = 200_000, 2


class SuffixAutomaton:
    """Of several sequences; ``next``, ``link`` and ``length`` by state, 0 the empty sequence."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def state(self, length: int, arcs: dict[int, int], link: int) -> int:
        self.next.append(arcs)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def split(self, p: int, q: int, symbol: int) -> int:
        """A copy of ``q`` for the sequences no longer than ``p`` with ``symbol``."""
        copy = self.state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = copy
            p = self.link[p]
        return copy

    def extend(self, last: int, symbol: int) -> int:
        """The state of the current sequence with ``symbol`` after ``last``; 0 begins a sequence."""
        there = self.next[last].get(symbol)
        if there is not None:
            return there if self.length[there] == self.length[last] + 1 else self.split(last, there, symbol)
        new, p = self.state(self.length[last] + 1, {}, 0), last
        while p >= 0 and symbol not in self.next[p]:
            self.next[p][symbol] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][symbol]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self.split(p, q, symbol)
        return new

    def step(self, state: int, matched: int, symbol: int) -> tuple[int, int]:
        """The longest match after ``symbol``, from the longest match before it."""
        while state and symbol not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        there = self.next[state].get(symbol)
        return (0, 0) if there is None else (there, matched + 1)

    def owners(self, length: int) -> list[int]:
        """By state, the state of the last ``length`` symbols of what it stands for; shorter ones are their own."""
        out = list(range(len(self.length)))
        # A state's link is shorter than it and so comes before it.
        for state in sorted(range(1, len(out)), key=self.length.__getitem__):
            if self.length[self.link[state]] >= length:
                out[state] = out[self.link[state]]
        return out


@dataclass
class Matcher:
    """An automaton of items with the items of each window, keyed by the window's state."""

    window: int
    words: dict[bytes, int] = field(default_factory=dict)
    automaton: SuffixAutomaton = field(default_factory=SuffixAutomaton)
    windows: dict[int, set[str]] = field(default_factory=dict)
    #: Items shorter than a window, by state and length.
    short: dict[tuple[int, int], set[str]] = field(default_factory=dict)
    lengths: set[int] = field(default_factory=set)
    #: By length (a window's, and those of shorter items): the owner of every state, so that no chain is walked.
    owners: dict[int, list[int]] = field(default_factory=dict)

    def build(self, items: list[tuple[str, bytes]]) -> Matcher:
        sequences = []
        for item, text in items:
            numbers = [self.words.setdefault(w, len(self.words)) for w in find_words(text.lower())]
            if numbers:
                last = 0
                for n in numbers:
                    last = self.automaton.extend(last, n)
                sequences.append((item, numbers))
        # States are final only now.
        self.lengths = {n for _, own in sequences if (n := len(own)) < self.window}
        self.owners = {n: self.automaton.owners(n) for n in {self.window, *self.lengths}}
        whole = self.owners[self.window]
        for item, numbers in sequences:
            state = matched = 0
            for n in numbers:
                state, matched = self.automaton.step(state, matched, n)
                if matched >= self.window:
                    self.windows.setdefault(whole[state], set()).add(item)
            if len(numbers) < self.window:
                self.short.setdefault((self.owners[len(numbers)][state], len(numbers)), set()).add(item)
        return self

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs [from, to) of hit words, ascending and disjoint, and the items found."""
        least = min(self.lengths, default=self.window)
        numbers = np.fromiter((self.words.get(w, -1) for w in words), np.int64, len(words))
        # Only runs of words that items have, long enough for a window, are streamed.
        known = np.flatnonzero(np.diff(np.concatenate(([0], (numbers >= 0).view(np.int8), [0]))))
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        step, whole = self.automaton.step, self.owners[self.window]
        lengths = [(n, self.owners[n]) for n in sorted(self.lengths)]
        for low, high in zip(known[::2].tolist(), known[1::2].tolist(), strict=True):
            if high - low < least:
                continue
            state = matched = 0
            for at, symbol in enumerate(numbers[low:high].tolist(), low):
                state, matched = step(state, matched, symbol)
                if matched < least:
                    continue
                longest = 0
                if matched >= self.window:
                    found |= self.windows[whole[state]]
                    longest = self.window
                for n, owner in lengths:
                    if n <= matched and (items := self.short.get((owner[state], n))):
                        found |= items
                        longest = max(longest, n)
                if longest:
                    begin = at + 1 - longest
                    while spans and spans[-1][1] >= begin:
                        begin = min(begin, spans.pop()[0])
                    spans.append((begin, at + 1))
        return spans, found


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def item_blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str, bytes]]]:
    """Items (id as text, bytes) in blocks of about ``block_words`` words, read one block at a time."""
    held, size = [], 0
    given = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), text_bytes().alias("text"))
    for row in given.toLocalIterator():
        held.append((row["item"], bytes(row["text"])))
        size += len(row["text"]) // 2 + 1
        if size >= block_words:
            yield held
            held, size = [], 0
    if held:
        yield held


#: What is found of a document, under names of its own, so that a document's columns may be called anything else.
FOUND = {"__n_words": "long", "__spans": "array<struct<low:long,high:long>>", "__items": "array<string>"}


def find(docs: DataFrame, benchmark: DataFrame, *, window: int = 13, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with the columns of FOUND: number of words, runs of hit words [low, high), and ids of the items found, sorted as text.

    A null or wordless text has no hits. A null item_id counts as an item named ``null``; an item
    without words has no window. Rows are independent; an empty benchmark hits nothing. Time is in
    proportion to the words, whatever repeats in items or texts.
    """
    names = docs.columns
    out = docs.withColumns({n: F.lit(None).cast(t) for n, t in FOUND.items()})
    schema = out.schema

    def scanner(packed) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher: Matcher = pickle.loads(packed.value)
            text_at, own = names.index("text"), len(names)
            for batch in sliced(batches):
                n_words, spans, items = [], [], []
                old_spans, old_items = batch.column(own + 1).to_pylist(), batch.column(own + 2).to_pylist()
                for raw, before, had in zip(raw_texts(batch.column(text_at)), old_spans, old_items, strict=True):
                    words = find_words(raw.lower())
                    runs, found = matcher.scan(words)
                    n_words.append(len(words))
                    spans.append([{"low": a, "high": b} for a, b in united(runs + [(s["low"], s["high"]) for s in before or ()])])
                    items.append(sorted(found.union(had or ())))
                made = [pa.array(n_words, pa.int64()), pa.array(spans, batch.schema.field(own + 1).type), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:own], *made], names=[*names, *FOUND])

        return run

    spark = docs.sparkSession
    blocks = item_blocks(benchmark, block_words)
    items, number = next(blocks, []), 0
    while items is not None:
        if number and number % STAGE_BLOCKS == 0:
            # Every step of a stage is a Python process of each task: begin a new stage.
            out = materialise(out, "decontamination")
        # Bounded by ``block_words``, whatever the size of the benchmark.
        packed = spark.sparkContext.broadcast(pickle.dumps(Matcher(window).build(items)))
        out = out.mapInArrow(scanner(packed), schema)
        items, number = next(blocks, None), number + 1
    return out


def digest(found: DataFrame, coverage: int = 20) -> dict[str, Column]:
    """The contract's columns of what ``find`` gave; contaminated: one word in ``coverage`` is hit, or more."""
    hit = F.aggregate("__spans", F.lit(0).cast("long"), lambda a, s: a + s["high"] - s["low"])
    items = F.sha2(F.array_join("__items", ","), 256)
    return {"n_words": F.col("__n_words"), "n_hit": hit, "n_items": F.size("__items").cast("long"), "items_sha256": items, "contaminated": (hit > 0) & (hit * coverage >= F.col("__n_words"))}


def remove(docs: DataFrame, benchmark: DataFrame, *, window: int = 13, most_words: int | None = None, coverage: int = 20, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without contamination, columns as given, whatever they are called.

    A document of which one word in ``coverage`` or more is hit goes. In one that stays, runs of
    hit words longer than ``most_words`` are cut out of the text, up to the next word; None cuts none.
    """
    found = find(docs, benchmark, window=window, block_words=block_words)
    clean, kept = found.where(~digest(found, coverage)["contaminated"]), docs.columns
    if most_words is None:
        return clean.select(*kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_at = kept.index("text")
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column(text_at).to_pylist(), batch.column(len(kept)).to_pylist(), strict=True):
                long = [s for s in spans if s["high"] - s["low"] > most_words]
                if long:
                    raw = text.encode()
                    starts = [m.start() for m in WORD.finditer(raw.lower())] + [len(raw)]
                    parts, low = [], 0
                    for s in long:
                        parts.append(raw[low : starts[s["low"]]])
                        low = starts[s["high"]]
                    text = b"".join([*parts, raw[low:]]).decode()
                texts.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if k == text_at else batch.column(k) for k in range(len(kept))], names=kept)

    return clean.select(*kept, "__spans").mapInArrow(run, docs.schema)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", *[c.alias(n) for n, c in digest(found).items()])


def op7_brute_force(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]], window: int = 13) -> dict[int, tuple]:
    """The same rows by comparing every window of every document with a dictionary of windows."""
    table_of: dict[tuple, set[str]] = {}
    for item, text in items:
        words = find_words((text or "").encode().lower())
        n = min(window, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            table_of.setdefault(tuple(words[k : k + n]), set()).add(str(item))
    lengths, out = sorted({len(w) for w in table_of}), {}
    for doc, text in docs:
        words, hit, found = find_words((text or "").encode().lower()), set(), set()
        for n in lengths:
            for k in range(len(words) - n + 1):
                if own := table_of.get(tuple(words[k : k + n])):
                    found |= own
                    hit.update(range(k, k + n))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc] = (len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words))
    return out


OP7_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), bw AS (
  SELECT item_id, words, CASE WHEN len(words) < 13 THEN len(words) ELSE 13 END AS k FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark) b
  WHERE len(words) > 0
), bi AS (SELECT item_id, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM bw),
wins AS (SELECT DISTINCT item_id, k, array_to_string(words[i:i + k - 1], ' ') AS w FROM bi),
ks AS (SELECT DISTINCT k FROM wins),
di AS (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM dw, ks WHERE len(words) >= k),
dwin AS (SELECT doc_id, k, i, array_to_string(words[i:i + k - 1], ' ') AS w FROM di),
hits AS (SELECT DISTINCT d.doc_id, d.k, d.i, b.item_id FROM dwin d JOIN wins b ON d.w = b.w AND d.k = b.k),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, k, i FROM hits) h) q GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) h GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(dw.words) AS BIGINT) AS n_words, CAST(coalesce(pos.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(its.n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(its.items, '')) AS items_sha256, coalesce(pos.n_hit, 0) > 0 AND 20 * coalesce(pos.n_hit, 0) >= len(dw.words) AS contaminated
FROM dw LEFT JOIN pos ON dw.doc_id = pos.doc_id LEFT JOIN its ON dw.doc_id = its.doc_id
"""
