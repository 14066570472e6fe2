"""Language-model scores by a weighted backoff automaton over smoothed trigrams.

A state is a history that training texts hold: none, the last word, or the last two. A state's
arcs are the words seen after it; for any other word a failure arc leads, at a cost, to the
shorter history that is a state, and at last to the root, where every known word and the unknown
word have an arc. Smoothing is a Dirichlet prior on the shorter history: with c(h) continuations
of history h in training, and p the weight that the shorter history gives,

    arc(h, w)  = (c(h, w) + strength * p(w)) / (c(h) + strength)
    failure(h) = strength / (c(h) + strength)
    p(w)       = (c(w) + 0.5) / (N + 0.5 * (V + 1)) at the root, the last share for any unknown word

so the weights leaving a state sum to one. A traversal reads a text from left to right,
carries the state, follows failure arcs until an arc takes the word, and adds up log10 weights.

The automaton of a large corpus fits nowhere whole. A block of texts can only reach the
states and arcs of its own words, pairs and triples, so each block is given exactly those, with
counts over all training texts (``blocks.exchange``), and is traversed where it lies. Triples are
exchanged only where that can tell anything: if no other block holds a triple's first pair, or none
its last, then no other block holds the triple.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import Asked, Block, Counted, exchange, in_blocks, mixed, read_answers, release_memory
from .common import id_crc, long_id, table, text_bytes

#: Keys of the start of a text and of the end token; no word hashes to them but by chance.
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
#: Tokens whose arcs are laid out at once for a traversal.
STRIDE = 50_000


@dataclass
class Tokens:
    """A block's tokens in reading order: keys of the word, of the pair and of the triple that it ends.

    The first token of a text ends no triple, and its pair begins with the start of the text.
    ``keys`` are the distinct keys of words, and of the start, ascending; ``number`` is each token's place among them.
    """

    keys: np.ndarray
    number: np.ndarray
    word: np.ndarray
    pair: np.ndarray
    triple: np.ndarray
    first: np.ndarray
    ends: np.ndarray
    learn: np.ndarray

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs, ascending, and each token's place among them."""
        return np.unique(self.pair, return_inverse=True)


def tokens_of(block: Block) -> Tokens:
    sizes = np.diff(block.ends, prepend=0) + 1
    ends = np.cumsum(sizes)
    first = ends - sizes
    keys, place = np.unique(np.concatenate((block.words, np.array([END, START]))), return_inverse=True)
    number = np.full(int(ends[-1]), place[-2])
    inner = np.ones(len(number), bool)
    inner[ends - 1] = False
    number[inner] = place[block.index]
    word = keys[number]
    before = np.empty_like(word)
    before[1:], before[first] = word[:-1], START
    pair = mixed(before, word)
    before[1:], before[first] = pair[:-1], 0
    return Tokens(keys, number, word, pair, mixed(before, word), first, ends, np.repeat(np.array(block.rows["learn"].to_pylist(), bool), sizes))


def counted(distinct: np.ndarray, number: np.ndarray, learn: np.ndarray) -> Counted:
    return distinct, np.bincount(number, weights=learn, minlength=len(distinct)).astype(np.int64)


def word_keys(t: Tokens) -> Counted:
    """Words, and the start of the text as a history that every text continues once."""
    keys, counts = counted(t.keys, t.number, t.learn)
    counts[np.searchsorted(keys, START)] += int(t.learn[t.first].sum())
    return keys, counts


def ask_words(block: Block, _: list[np.ndarray] | None) -> list[Counted]:
    return [word_keys(tokens_of(block))]


#: A pair's count in training lies below this bit, and the number of blocks that hold it at all above.
HOLDERS = 40


def ask_pairs(block: Block, _: list[np.ndarray] | None) -> list[Counted]:
    t = tokens_of(block)
    pairs, counts = counted(*t.pairs, t.learn)
    return [word_keys(t), (pairs, counts + (1 << HOLDERS))]


def open_triples(t: Tokens, pairs: np.ndarray) -> np.ndarray:
    """Tokens whose triple other blocks may hold; ``pairs``: the answers for the block's pairs."""
    shared = (pairs >> HOLDERS > 1)[t.pairs[1]]
    history = np.empty_like(shared)
    history[1:], history[t.first] = shared[:-1], False
    return shared & history


def ask_triples(block: Block, had: list[np.ndarray]) -> list[Counted]:
    t = tokens_of(block)
    wanted = open_triples(t, had[1])
    return [counted(*np.unique(t.triple[wanted], return_inverse=True), t.learn[wanted])]


def root_weights(counts: np.ndarray, sums: Asked) -> np.ndarray:
    return (counts + 0.5) / (sums.total + 0.5 * (sums.keys + 1))


def root_walk(t: Tokens, words: np.ndarray, sums: Asked) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By text, where the root is the only state: base score, score, known tokens, failure arcs followed."""
    counts = words[t.number]
    base = np.add.reduceat(np.log10(root_weights(counts, sums)), t.first)
    return base, base, np.add.reduceat((counts > 0).astype(np.int64), t.first), np.zeros(len(t.first), np.int64)


class Automaton:
    """The states and arcs that one block's tokens reach; ``walk`` traverses it once for each text."""

    def __init__(self, t: Tokens, words: np.ndarray, pairs: np.ndarray, triples: np.ndarray, sums: Asked, strength: float):
        """``words``, ``pairs`` and ``triples``: answers for the block's words, its pairs and its open triples, by ascending key."""
        self.tokens, self.strength = t, strength
        self.word = words[t.number]
        self.pair = (pairs & ((1 << HOLDERS) - 1))[t.pairs[1]]
        distinct, number = np.unique(t.triple, return_inverse=True)
        total = counted(distinct, number, t.learn)[1]
        wanted = np.zeros(len(distinct), bool)
        wanted[number[open_triples(t, pairs)]] = True
        total[wanted] = triples
        self.triple = total[number]
        # How often the histories before a token are continued: the word before, and the pair before.
        self.after_word, self.after_pair = np.empty_like(self.word), np.zeros_like(self.pair)
        self.after_word[1:], self.after_word[t.first] = self.word[:-1], words[np.searchsorted(t.keys, START)]
        self.after_pair[1:], self.after_pair[t.first] = self.pair[:-1], 0
        self.root = root_weights(self.word, sums)

    def arcs(self) -> tuple[np.ndarray, ...]:
        """By token: log10 weights of the root's arc, of the word state's arc and failure, of the pair state's arc and failure.

        A weight of 1 stands for an arc that is not there; real ones are negative.
        """
        s, n1, n2 = self.strength, self.after_word, self.after_pair
        arc1 = np.where(self.pair > 0, (self.pair + s * self.root) / (n1 + s), 0)
        lower = np.where(self.pair > 0, arc1, np.where(n1 > 0, s / (n1 + s), 1.0) * self.root)
        arc2 = np.where(self.triple > 0, (self.triple + s * lower) / (n2 + s), 0)

        def log(weight: np.ndarray, there: np.ndarray) -> np.ndarray:
            return np.where(there, np.log10(np.where(there, weight, 1.0)), 1.0)

        return np.log10(self.root), log(arc1, self.pair > 0), log(s / (n1 + s), n1 > 0), log(arc2, self.triple > 0), log(s / (n2 + s), n2 > 0)

    def walk(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """By text: base score, score, known tokens, failure arcs followed."""
        t = self.tokens
        root, arc1, fail1, arc2, fail2 = self.arcs()
        # The state a token leads to: the longest of its histories that training continues.
        leads = np.where(self.pair > 0, 2, np.where(self.word > 0, 1, 0)).astype(np.uint8)
        begins = np.zeros(len(root), bool)
        begins[t.first] = True
        steps, failures = np.empty(len(root)), np.empty(len(root), np.int64)
        state, start = 0, 1 if len(t.first) and self.after_word[t.first[0]] > 0 else 0
        for low in range(0, len(root), STRIDE):
            span = slice(low, low + STRIDE)
            weights: list[float] = []
            failed: list[int] = []
            for new, to, w0, w1, f1, w2, f2 in zip(*[a[span].tolist() for a in (begins, leads, root, arc1, fail1, arc2, fail2)], strict=True):
                if new:
                    state = start
                weight, n = 0.0, 0
                while True:
                    if state == 2:
                        if w2 < 1:
                            weight += w2
                            break
                        # The pair before is a state, so the word before is one too.
                        weight, n, state = weight + f2, n + 1, 1
                    elif state == 1:
                        if w1 < 1:
                            weight += w1
                            break
                        weight, n, state = weight + f1, n + 1, 0
                    else:
                        weight += w0
                        break
                state = to
                weights.append(weight)
                failed.append(n)
            steps[span], failures[span] = weights, failed
        add = np.add.reduceat
        return add(np.log10(self.root), t.first), add(steps, t.first), add((self.word > 0).astype(np.int64), t.first), add(failures, t.first)


SCORED = "doc_id long, learnt boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_failures long"


def score(docs: DataFrame, learn: Column, *, strength: float = 8.0, history: int = 2, name: str = "lm") -> DataFrame:
    """Score every row of ``docs`` (doc_id of any integer type, text) by the automaton learnt from rows where ``learn`` holds.

    Words are split at ASCII white space after lowering A-Z; every text, a null one too, ends in
    an end token. A null in ``learn`` counts as false. Repeated rows count as often as they stand
    there; an empty table gives no rows. If nothing is learnt, every token has the unknown word's share.

    ``history`` is the most words that a state holds, 2 or 0. With 0 the root is the only state, so ``score`` is
    ``base_score``, no failure arc is followed, and pairs and triples are neither counted nor exchanged.
    """
    if history not in (0, 2):
        raise ValueError("history must be 0 or 2")
    given = docs.select(long_id(), F.coalesce(learn, F.lit(False)).alias("learn"), text_bytes().alias("text"))
    blocks = in_blocks(given, f"{name}-blocks")
    if history:
        found, sums = exchange(blocks, ask_pairs, 2, f"{name}-pairs", uncounted=(int(START),))
        found, _ = exchange(found, ask_triples, 1, f"{name}-triples")
    else:
        found, sums = exchange(blocks, ask_words, 1, f"{name}-words", uncounted=(int(START),))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block = Block.unpack(batch.column(0)[k].as_py())
                t = tokens_of(block)
                had = read_answers(batch.column(1)[k].as_py())
                base, scores, known, failures = Automaton(t, *had, sums[0], strength).walk() if history else root_walk(t, *had, sums[0])
                n = block.rows.num_rows
                columns = [block.rows["doc_id"].combine_chunks(), block.rows["learn"].combine_chunks(), np.diff(t.ends, prepend=0), known, np.full(n, sums[0].total), base, scores, failures]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=[f.split()[0] for f in SCORED.split(", ")])
                release_memory()

    return found.select("payload", "answers").mapInArrow(run, SCORED)


def op2_lm_scoring(spark: SparkSession, sf_dir: str, *, history: int = 2) -> DataFrame:
    learn = id_crc("doc_id", 5) != 1
    scored = score(table(spark, sf_dir, "documents"), learn, history=history)
    return scored.select("doc_id", (~F.col("learnt")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_failures")
