"""Toxicity by weak supervision.

Voters are lexicons and patterns: a small fixed lexicon, lexicons of words and of word
stems mined from labelled rows, repeated hits, the absence of any hit, many capitals, many
marks, and stretched or masked words. A generative
model of their votes estimates, without trusting any one of them, how often each is right
for either class, the labels being one more voter, and how voters err together: each depends on the
class and on the one other voter it agrees with most beyond it. Its posterior labels train a linear classifier, and that alone scores texts.

Training reads at most ``train_rows`` labelled rows, those of the smallest hashed ids.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_crc, materialise, raw_texts, sliced, table, text_bytes

find_words = re.compile(rb"[a-z\x80-\xff]+").findall
#: Words with a letter three times in a row (not ``www``), and with marks between letters.
find_bent = re.compile(rb"([A-Va-vX-Zx-z])\1\1|[A-Za-z][*#$%!]+[A-Za-z]").findall
#: Common English insults: a starting point that needs no labels.
SEED_WORDS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown", "dumb", "fool", "jerk", "garbage", "imbecile")
STEMS = (4, 5, 6)
TRAIN_ROWS, TERMS, LEAST = 12_000, 400, 5
#: Log odds from which a term counts as a hit, and the most hits that count.
STRONG, MOST_HITS = 2.5, 3
#: How often labels are believed right beforehand, of clean and of toxic texts.
LABEL_RIGHT = (0.99, 0.97)
#: Mutual information, given the class, from which one voter depends on another.
LEAST_SHARED = 0.002
#: Shares (of ``shape_of``) from which a pattern votes.
PATTERNS = {"capitals": 0.25, "marks": 0.03, "stretched or masked words": 0.02}
TOXIC, CLEAN = 1, -1


def terms_of(text: bytes) -> list[bytes]:
    """Distinct words of a text with A-Z lowered, and the distinct stems of longer ones, marked ``*``."""
    words = set(find_words(text.lower()))
    stems = {w[:k] + b"*" for w in words if len(w) > STEMS[0] for k in STEMS if len(w) > k}
    return [*words, *stems]


def shape_of(text: bytes) -> list[float]:
    """Pattern features: shares of capitals and marks, of stretched or masked words, and the length's logarithm."""
    n = max(1, len(text))
    capitals = sum(text.count(bytes([c])) for c in range(65, 91)) / n
    marks = sum(text.count(c) for c in (b"!", b"#", b"$", b"%", b"&", b"*", b"?")) / n
    return [capitals, marks, len(find_bent(text)) / (text.count(b" ") + 1), math.log10(n + 1) / 5]


def terms_hit(words: Iterable[bytes], odds: dict[bytes, float]) -> tuple[set[bytes], int]:
    """The features of a text, in training and in scoring alike: its terms, one for each distinct word, and how many words hit a strong one.

    Of a word itself and its stems the term of the largest odds counts, the longest among equals.
    """
    found, strong = set(), 0
    get = odds.get
    for w in words:
        best = get(w)
        term = w
        if len(w) > STEMS[0]:
            for k in STEMS:
                if len(w) > k:
                    stem = w[:k] + b"*"
                    value = get(stem)
                    if value is not None and (best is None or value > best):
                        best, term = value, stem
        if best is not None:
            found.add(term)
            strong += best > STRONG
    return found, strong


@dataclass
class Model:
    """Odds of terms, weights by term, of shapes and of the number of strong words, and the intercept. Empty: the seed lexicon alone."""

    odds: dict[bytes, float] = field(default_factory=lambda: {w.encode(): 4.0 for w in SEED_WORDS})
    terms: dict[bytes, float] = field(default_factory=lambda: {w.encode(): 4.0 for w in SEED_WORDS})
    shape: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)
    hits: float = 0.0
    bias: float = -3.0

    def score(self, text: bytes) -> float:
        found, strong = terms_hit(set(find_words(text.lower())), self.odds)
        # In one order, so that equal texts have equal scores to the last bit.
        z = self.bias + sum(map(self.terms.__getitem__, sorted(found))) + self.hits * min(strong, MOST_HITS)
        z += sum(a * b for a, b in zip(self.shape, shape_of(text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


Row = tuple[int, bytes, list[float]]


def mine(rows: list[Row], most: int, least: int) -> dict[bytes, float]:
    """Terms of toxic rows by log odds of standing in one, taken low: less 1.64 standard errors.

    The ``most`` strongest, each in ``least`` toxic rows, so that chance in rare terms counts little.
    Copies and near copies of a toxic row count once: those with the same smallest and largest hash
    of longer terms, or the same terms where longer ones are few.
    """
    toxic, seen, n = Counter(), set(), Counter()
    for y, terms, _ in rows:
        if y:
            own = terms.split()
            long = [zlib.crc32(t) for t in own if len(t) > 6]
            kind = (min(long), max(long)) if len(long) >= 20 else zlib.crc32(b" ".join(sorted(own)))
            if kind in seen:
                continue
            seen.add(kind)
            toxic.update(own)
        n[y] += 1
    toxic = {t: c for t, c in toxic.items() if c >= least}
    clean = Counter(t for y, terms, _ in rows if not y for t in terms.split() if t in toxic)

    def low(a: float, b: float) -> float:
        return math.log(a / (n[1] + 1) * (n[0] + 1) / b) - 1.64 * math.sqrt(1 / a + 1 / b)

    odds = {t: low(c + 0.5, clean[t] + 0.5) for t, c in toxic.items()}
    best = sorted((t for t, o in odds.items() if o > 1.0), key=lambda t: (-odds[t] * math.log1p(toxic[t]), t))
    return {t: odds[t] for t in best[:most]}


def votes_of(rows: list[Row], mined: dict[bytes, float]) -> tuple[np.ndarray, list[str]]:
    """Votes (rows by voters: 1 toxic, -1 clean, 0 none). Mined terms are dealt to four voters each for words and stems."""
    seed = {w.encode() for w in SEED_WORDS}
    strong = {t for t, o in mined.items() if o > STRONG}
    voters = ["seed lexicon", *[f"words {k}" for k in range(4)], *[f"stems {k}" for k in range(4)], "two strong terms", "no term at all", *PATTERNS, "label"]
    votes = np.zeros((len(rows), len(voters)), np.int8)
    ranked = {t: k for k, t in enumerate(mined)}
    for r, (y, blob, shape) in enumerate(rows):
        terms = blob.split()
        hit = [t for t in terms if t in mined]
        votes[r, 0] = TOXIC if seed.intersection(terms) else 0
        for t in hit:
            votes[r, (5 if t.endswith(b"*") else 1) + ranked[t] % 4] = TOXIC
        votes[r, 9] = TOXIC if sum(t in strong for t in hit) >= 2 else 0
        votes[r, 10] = 0 if hit else CLEAN
        votes[r, 11:-1] = [TOXIC if share >= least else 0 for share, least in zip(shape, PATTERNS.values(), strict=False)]
        votes[r, -1] = TOXIC if y else CLEAN
    return votes, voters


def tables(onehot: np.ndarray, q: np.ndarray, parents: list[int]) -> np.ndarray:
    """P(vote | parent's vote, class) as (class, voter, parent's vote, vote); without a parent the same for each of its votes."""
    out = np.empty((2, onehot.shape[1], 3, 3))
    for y, share in enumerate((1 - q, q)):
        for v, parent in enumerate(parents):
            votes = onehot[:, v].T
            counts = (onehot[:, parent] * share[:, None]).T @ votes.T if parent >= 0 else np.tile(votes @ share, (3, 1))
            # A little of the voter's own distribution, so that unseen pairs of votes weigh little.
            prior = (votes @ share + 0.1) / (share.sum() + 0.3)
            out[y, v] = (counts + prior) / (counts.sum(1, keepdims=True) + 1)
        # Labels are mostly right: as many rows say so beforehand as are read.
        believed = np.array([1 - LABEL_RIGHT[y], 0, LABEL_RIGHT[y]]) if y else np.array([LABEL_RIGHT[y], 0, 1 - LABEL_RIGHT[y]])
        out[y, -1] = (out[y, -1] * share.sum() + np.maximum(believed, 1e-6) * len(onehot)) / (share.sum() + len(onehot))
    return out


def dependence(onehot: np.ndarray, q: np.ndarray, free: int) -> list[int]:
    """Each voter's parent, -1 for none: a tree of the strongest dependences between voters that remain once the class is known.

    Conditional mutual information in nats, by a maximum spanning tree, edges under ``LEAST_SHARED`` left out.
    Voter ``free`` stands outside.
    """
    rows, voters, _ = onehot.shape
    shared = np.zeros((voters, voters))
    flat = onehot.reshape(rows, -1)
    for share in (1 - q, q):
        joint = ((flat * share[:, None]).T @ flat / rows + 1e-9).reshape(voters, 3, voters, 3).transpose(0, 2, 1, 3)
        mass = share.sum() / rows
        left, right = joint.sum(3, keepdims=True), joint.sum(2, keepdims=True)
        shared += (joint * np.log(joint * mass / (left * right))).sum((2, 3))
    np.fill_diagonal(shared, 0)
    parents, inside = [-1] * voters, {int(np.argmax(np.delete(shared, free, 0).sum(1)))}
    outside = [v for v in range(voters) if v not in inside and v != free]
    while outside:
        gain, child, parent = max((shared[c, p], c, p) for c in outside for p in inside)
        parents[child] = parent if gain >= LEAST_SHARED else -1
        inside.add(child)
        outside.remove(child)
    return parents


def label_model(votes: np.ndarray, prior: float, rounds: int = 30) -> tuple[np.ndarray, list[int]]:
    """Posterior of toxicity by row, and each voter's parent.

    Expectation maximisation over P(class) and P(vote | parent's vote, class): how often each voter is right for
    either class, and how voters err together, are both terms of the model, learnt without any truth.
    The tree of dependences is learnt anew every third of the rounds. The last voter, the label, has no parent.
    """
    onehot = np.stack([votes == v for v in (CLEAN, 0, TOXIC)], 2).astype(float)
    number = (votes + 1).astype(np.intp)
    q, parents = np.where(votes[:, -1] > 0, 0.9, 0.02).astype(float), [-1] * votes.shape[1]
    for step in range(rounds):
        if step and step % (rounds // 3) == 0:
            parents = dependence(onehot, q, votes.shape[1] - 1)
        told = tables(onehot, q, parents)
        logit = np.full(len(votes), math.log(prior / (1 - prior)))
        for v, parent in enumerate(parents):
            given = number[:, parent] if parent >= 0 else 0
            logit += np.log(told[1, v, given, number[:, v]]) - np.log(told[0, v, given, number[:, v]])
        q = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        prior = float(np.clip(q.mean(), 1e-3, 0.5))
    return q, parents


def fit(rows: list[Row], *, most: int = TERMS, least: int = LEAST) -> Model:
    """A linear classifier trained on posterior labels; the seed model if either class is missing.

    A row's terms stay one byte string and are split as they are needed: as objects they would fill the driver.
    """
    rows = sorted(rows, key=lambda r: (r[0], r[2], r[1]))
    share = sum(y for y, _, _ in rows) / max(1, len(rows))
    if not 0 < share < 1:
        return Model()
    mined = mine(rows, most, least)
    posterior, _ = label_model(votes_of(rows, mined)[0], share)
    number = {t: k for k, t in enumerate(mined)}
    x = np.zeros((len(rows), len(mined) + 6), np.float32)
    for r, (_, terms, shape) in enumerate(rows):
        found, strong = terms_hit((t for t in terms.split() if not t.endswith(b"*")), mined)
        x[r, [number[t] for t in found]] = 1
        x[r, -6], x[r, -5:-1], x[r, -1] = min(strong, MOST_HITS), shape, 1
    w = np.zeros(x.shape[1], np.float32)
    posterior = posterior.astype(np.float32)
    ridge = np.full(len(w), 2e-4, np.float32)
    ridge[-1], ridge[-6] = 0, 1e-5
    scale, velocity = 1 / max(1.0, float((x**2).sum(1).mean()) / 4), np.zeros_like(w)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - posterior) / len(rows) + ridge * w
        velocity = 0.9 * velocity - 4 * scale * gradient
        w += velocity
    return Model(mined, {t: float(w[k]) for t, k in number.items()}, tuple(map(float, w[-5:-1])), float(w[-6]), float(w[-1]))


def train(docs: DataFrame, labels: DataFrame, learn: Column, *, train_rows: int = TRAIN_ROWS) -> Model:
    """Learn from labelled documents for whose id ``learn`` holds; a document labelled twice is toxic if any label says so.

    ``train_rows`` ids are read at most, those of the smallest hashes; of rows that share an id the
    one of the smallest text. So the driver holds ``train_rows`` rows of distinct terms, however
    long a text is. Null and empty texts are rows without terms.
    """
    chosen = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(learn).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # At most ``train_rows`` pairs of integers: small enough to send to every executor.
    chosen = F.broadcast(materialise(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows), "toxicity-ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_py() for x in batch.column(2)]
            prints = [hashlib.blake2b(t, digest_size=16).digest() for t in texts]
            columns = [*batch.columns[:2], pa.array(prints, pa.binary()), pa.array([b" ".join(terms_of(t)) for t in texts], pa.binary()), pa.array([shape_of(t) for t in texts], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "toxic", "print", "terms", "shape"])

    given = docs.select("doc_id", text_bytes().alias("text")).join(chosen, "doc_id").select("doc_id", F.col("toxic").cast("int").alias("toxic"), "text")
    id_type = dict(given.dtypes)["doc_id"]
    read = given.mapInArrow(run, f"doc_id {id_type}, toxic int, print binary, terms binary, shape array<double>")
    # One row an id: combined before it is shuffled, however often an id repeats.
    found = read.groupBy("doc_id").agg(F.min(F.struct("print", "toxic", "terms", "shape")).alias("row")).select("row.*")
    return fit([(int(r["toxic"] > 0), bytes(r["terms"]), list(r["shape"])) for r in found.toLocalIterator()])


def score(docs: DataFrame, model: Model, *, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from 0.5 on), texts only being read.

    A null or empty text has the score of no evidence. Rows are independent; other columns pass
    through, and one that is called like a result is replaced.
    """
    kept = [c for c in docs.columns if c not in names]
    given = docs.select(*kept, F.col("text").alias("__scored")) if "text" not in kept else docs.select(*kept)
    at = given.columns.index("text" if "text" in kept else "__scored")
    schema = docs.select(*kept, F.lit(0.0).alias(names[0]), F.lit(0).alias(names[1])).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            scores = [model.score(x) for x in raw_texts(batch.column(at))]
            made = [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *made], names=[*kept, *names])

    return given.mapInArrow(run, schema)


def reject(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without those predicted toxic, columns as given, whatever they are called."""
    return score(docs, model, names=("__score", "__predicted")).where("__predicted = 0").select(*docs.columns)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"), id_crc("doc_id", 5) != 0)
    scored = score(docs, model)
    return scored.select("doc_id", (id_crc("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
