"""SimHash near-duplicates by meeting in the middle: fingerprints emit balls, and those whose balls touch are linked.

Two fingerprints that differ in ``radius`` bits or fewer have a word between them, at most half the radius from
one and the other half from the other. Fingerprints emit the words around them, equal words meet, and who meets is near.

What a ball holds. An odd radius has no middle: one of the two must go a bit further. Those of an even number of
ones do, since two that differ in an odd number of bits have one of each kind:

* odd numbers of ones: all words within ``radius // 2`` flipped bits;
* even: the same, and for an odd radius also the words one flip further out whose flipped bits are all in one half of
  the 64. Of ``radius`` differing bits more than half lie in one half of the word, and those the even one flips.

For a radius of 3 that is 65 and 1,057 words instead of 2,081 each. Words are dealt to buckets by a linear hash, bits of
which are parities of bits of the word: which bucket a flipped word falls into follows from the bucket of
the fingerprint and that of the flips. So a fingerprint is sent once to every bucket that one of its words is in, and
the bucket makes the words itself, 2^21 at most: the number of buckets grows with the fingerprints.

Who meets at a word, at most a ball of distinct fingerprints, is linked to the one that flipped least, if both flipped no
more than ``radius`` bits together; two that flipped more meet again at a word nearer to both, if they are near.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_scratch, long_id, materialise, raw_texts, sliced, table, text_bytes
from .components import components

WIDTH, RADIUS, SHINGLE, SEED = 64, 3, 3, 42
#: Words of balls that a bucket should make, and the fewest and most buckets.
BUCKET_WORDS, LEAST_BUCKETS, MOST_BUCKETS = 1 << 21, 16, 1 << 20
#: Fingerprints of a task that are sent together, and hashes summed at once.
SENT, SUMMED = 4096, 1 << 16
CAPITALS = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(raw: bytes, length: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of all word ``length``-grams of a text, repeats included, in blocks; of all its words if fewer; none without words."""
    words = raw.translate(CAPITALS).split()
    if 0 < len(words) < length:
        words = [b" ".join(words)]
        length = 1
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: max(0, len(words) - length + 1)].tolist()
    stops = (ends[length - 1 :] - 1).tolist()
    of = xxhash.xxh64_intdigest
    for low in range(0, len(starts), SUMMED):
        some = zip(starts[low : low + SUMMED], stops[low : low + SUMMED], strict=True)
        yield np.array([of(text[a:b], SEED) for a, b in some], np.uint64)


def simhash(raw: bytes, length: int = SHINGLE) -> int:
    """Bit k is 1 if it is in over half of the hashes; 0 for a text without words."""
    ones, n = np.zeros(WIDTH, np.int64), 0
    for hashes in shingle_hashes(raw, length):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprinted(docs: DataFrame, length: int = SHINGLE) -> DataFrame:
    """(doc_id, print as a signed long) of rows (doc_id long, text bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            made = np.array([simhash(raw, length) for raw in raw_texts(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], names=["doc_id", "print"])

    return docs.mapInArrow(run, "doc_id long, print long")


class Balls:
    """The flips of each kind of fingerprint, and the buckets they lead to: ``buckets`` is a power of two."""

    def __init__(self, radius: int, buckets: int):
        if not 0 <= radius <= 5:
            raise ValueError("radius: 0 to 5 differing bits")
        self.radius, self.buckets = radius, buckets
        half = radius // 2
        near = [(c, n) for n in range(half + 1) for c in combinations(range(WIDTH), n)]
        further = [(c, half + 1) for low in (0, WIDTH // 2) for c in combinations(range(low, low + WIDTH // 2), half + 1)] if radius % 2 else []
        # A linear hash: 64 fixed words, one for each bit, drawn from a hash so that no structure of the prints meets one of theirs.
        self.columns = np.array([xxhash.xxh64_intdigest(bytes([k]), SEED) & (buckets - 1) for k in range(WIDTH)], np.int64)
        self.tables = np.zeros((8, 256), np.int64)
        for byte in range(8):
            for bit in range(8):
                self.tables[byte, (np.arange(256) >> bit & 1) == 1] ^= self.columns[8 * byte + bit]
        self.kinds = [self.led(near + further), self.led(near)]
        self.words = max(len(near) + len(further), 1)

    def led(self, flips: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By what they change a bucket's number with: masks and how many bits they flip."""
        masks = np.array([sum(1 << b for b in c) for c, _ in flips], np.uint64)
        sizes = np.array([n for _, n in flips], np.int64)
        to = self.bucket(masks)
        order = np.argsort(to, kind="stable")
        found, at = np.unique(to[order], return_index=True)
        return {int(k): (m, s) for k, m, s in zip(found, np.split(masks[order], at[1:]), np.split(sizes[order], at[1:]), strict=True)}

    def bucket(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), np.int64)
        for byte in range(8):
            out ^= self.tables[byte, ((words >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.int64)]
        return out

    def of_kind(self, prints: np.ndarray) -> list[np.ndarray]:
        odd = (np.bitwise_count(prints) & 1).astype(bool)
        return [prints[~odd], prints[odd]]

    def destinations(self, prints: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(bucket, prints that have a word there)."""
        to, sent = [], []
        for own, led in zip(self.of_kind(prints), self.kinds, strict=True):
            if len(own):
                to.append((self.bucket(own)[:, None] ^ np.array(list(led), np.int64)[None, :]).ravel())
                sent.append(np.repeat(own, len(led)))
        if not to:
            return
        dest, prints = np.concatenate(to), np.concatenate(sent)
        order = np.argsort(dest, kind="stable")
        found, at = np.unique(dest[order], return_index=True)
        yield from zip(found.tolist(), np.split(prints[order], at[1:]), strict=True)

    def meetings(self, bucket: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs of those of ``prints`` that meet at words of this bucket, each pair once."""
        words, owners, flipped = [], [], []
        for own, led in zip(self.of_kind(prints), self.kinds, strict=True):
            if not len(own):
                continue
            change = self.bucket(own) ^ bucket
            order = np.argsort(change, kind="stable")
            found, at = np.unique(change[order], return_index=True)
            for k, some in zip(found.tolist(), np.split(own[order], at[1:]), strict=True):
                if k in led:
                    masks, sizes = led[k]
                    words.append((some[:, None] ^ masks[None, :]).ravel())
                    owners.append(np.repeat(some, len(masks)))
                    flipped.append(np.tile(sizes, len(some)))
        if not words:
            return prints[:0], prints[:0]
        word, owner, flips = np.concatenate(words), np.concatenate(owners), np.concatenate(flipped)
        del words, owners, flipped
        order = np.lexsort((flips, word))
        word, owner, flips = word[order], owner[order], flips[order]
        first = np.concatenate([[True], word[1:] != word[:-1]])
        lead = np.maximum.accumulate(np.where(first, np.arange(len(word)), 0))
        linked = ~first & (flips + flips[lead] <= self.radius)
        a, b = owner[lead[linked]], owner[linked]
        near = np.bitwise_count(a ^ b) <= self.radius
        pairs = np.unique(np.stack([np.minimum(a, b)[near], np.maximum(a, b)[near]]), axis=1)
        return pairs[0], pairs[1]


def links(prints: DataFrame, *, radius: int = RADIUS, bucket_words: int = BUCKET_WORDS, name: str = "simhash") -> DataFrame:
    """Stored (a, b): pairs of distinct ``prints`` (print long) within ``radius`` bits that connect all such pairs.

    Not every near pair is there, but any two near ones are connected by pairs that are.
    """
    size = prints.count()
    words = Balls(radius, 1).words
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << max(0, (size * words // bucket_words)).bit_length()))
    balls = Balls(radius, buckets)

    def sending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, SENT):
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            made = [(b, p.tobytes()) for b, p in balls.destinations(own)]
            for low in range(0, len(made), 1024):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made[low : low + 1024], strict=True), (pa.int32(), pa.binary()), strict=True)], names=["bucket", "prints"])

    def meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = -1, []
        for batch in batches:
            for bucket, raw in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1)), strict=True):  # noqa: B007
                held.append(np.frombuffer(raw, np.uint64))
        if held:
            a, b = balls.meetings(bucket, np.concatenate(held))
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    # One task a bucket: its prints are bounded by what it should make.
    dealt = prints.select("print").mapInArrow(sending, "bucket int, prints binary").repartitionById(buckets, F.col("bucket"))
    return materialise(dealt.mapInArrow(meeting, "a long, b long").distinct(), f"{name}-links")


def near_duplicates(docs: DataFrame, *, length: int = SHINGLE, radius: int = RADIUS, bucket_words: int = BUCKET_WORDS, name: str = "simhash") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id of any integer type, text); other columns are ignored.

    ``fingerprint`` is 16 hex digits. ``component_id`` is the smallest doc_id reachable by links of ``radius``
    differing bits or fewer. Texts without words, null ones too, have the fingerprint zero and are linked like any other.
    Repeated rows are rows of one component; a null doc_id is never the smallest unless its component has no other.
    """
    rows = materialise(fingerprinted(docs.select(long_id(), text_bytes()), length), f"{name}-rows")
    nodes = materialise(rows.groupBy("print").agg(F.min("doc_id").alias("least")), f"{name}-nodes")
    edges = links(nodes, radius=radius, bucket_words=bucket_words, name=name)
    label = components(edges, name)
    placed = materialise(nodes.join(label, nodes["print"] == label["node"], "left").select("print", "least", F.coalesce("label", "print").alias("label")), f"{name}-placed")
    least = placed.groupBy("label").agg(F.min("least").alias("component_id"))
    named = materialise(placed.join(least, "label").select("print", "component_id"), f"{name}-named")
    drop_scratch(nodes, edges, placed)
    return rows.join(named, "print").select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
