"""Exact corpus-wide counts of 64-bit keys, brought back to the documents that need them.

Texts are split into words once and kept in blocks, as word numbers. Each block asks for the keys it
holds: sorted, distinct, with its own counts already summed, cut by key range into buckets. One
task a bucket adds what all blocks sent and answers in the order asked, so an answer is counts
alone and a block rebuilds its keys to read them. A key as frequent as may be reaches its bucket
once a block, and nothing is collected or broadcast.

Buckets grow with the texts up to ``MOST_BUCKETS`` and then stay: from there on blobs, like bytes,
grow in proportion to the blocks. So a bucket may be larger than memory. It is then summed as
sorted runs on the task's own disk, merged slice by slice of the key range.
"""

from __future__ import annotations

import contextlib
import ctypes
import re
import struct
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, materialise, shuffle_width

BLOCK_BYTES = 6 << 20
#: Text bytes of one bucket, and the most buckets; keys that a task sums at once.
BUCKET_BYTES, MOST_BUCKETS, RUN_KEYS = 32 << 20, 4096, 2_000_000
#: Words whose hashes a Python process keeps, and bytes of a text that are split at once.
CACHED, PIECE = 300_000, 1 << 20

find_space = re.compile(rb"[ \t-\r]").search

Counted = tuple[np.ndarray, np.ndarray]


class Asked(NamedTuple):
    """Summed counts of a family of keys: number of keys counted at all, and the sum."""

    keys: int
    total: int


def to_planes(values: np.ndarray) -> bytes:
    """Unsigned integers, least significant bytes first, compressed by byte position."""
    width = values.dtype.itemsize
    planes = np.ascontiguousarray(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def from_planes(blob: bytes, width: int = 8) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(-1)


def join_blobs(blobs: list[bytes]) -> bytes:
    return struct.pack(f"<{len(blobs) + 1}I", len(blobs), *map(len, blobs)) + b"".join(blobs)


def split_blobs(raw: bytes) -> list[bytes]:
    (n,) = struct.unpack_from("<I", raw)
    at, out = 4 * (n + 1), []
    for size in struct.unpack_from(f"<{n}I", raw, 4):
        out.append(raw[at : at + size])
        at += size
    return out


class WordHashes:
    """64-bit hashes of words, each computed once while it stays cached."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        new = set(words).difference(self.known)
        if new:
            if len(self.known) > CACHED:
                self.known.clear()
                new = set(words)
            digest = xxhash.xxh3_64_intdigest
            self.known.update((w, digest(w)) for w in new)
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))

    def of_text(self, text: bytes) -> np.ndarray:
        """Of the words of a text, A-Z lowered, split at ASCII white space; a long text is split piece by piece."""
        if len(text) <= PIECE:
            return self(text.lower().split())
        parts, low = [], 0
        while low < len(text):
            space = find_space(text, low + PIECE)
            high = space.start() if space else len(text)
            parts.append(self(text[low:high].lower().split()))
            low = high
        return np.concatenate(parts)


hashes = WordHashes()


def release_memory(*, words: bool = False) -> None:
    """Give back what the allocators of this Python process keep after a block; ``words``: the cached hashes too."""
    if words:
        hashes.known.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def mixed(*parts: np.ndarray) -> np.ndarray:
    """One well-spread 64-bit key of several, their order included."""
    key = np.zeros_like(parts[0])
    for part in parts:
        key = (key ^ part) * np.uint64(0xFF51AFD7ED558CCD)
        key ^= key >> np.uint64(32)
        key *= np.uint64(0xC4CEB9FE1A85EC53)
        key ^= key >> np.uint64(29)
    return key


def to_payload(batch: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(batch)
    return sink.getvalue().to_pybytes()


def from_payload(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(raw).read_all()


@dataclass
class Block:
    """Rows without their texts, and the texts as word numbers: ``words[index]`` are the keys of all words in order."""

    rows: pa.Table
    words: np.ndarray
    index: np.ndarray
    ends: np.ndarray

    @property
    def keys(self) -> np.ndarray:
        return self.words[self.index]

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate(([0], self.ends[:-1])).astype(np.int64)

    @classmethod
    def of(cls, rows: pa.Table) -> Block:
        texts = [hashes.of_text(t.as_py()) for t in rows["text"]]
        ends = np.cumsum(np.array([len(t) for t in texts], np.int64))
        words, index = np.unique(np.concatenate(texts), return_inverse=True)
        return cls(rows.drop_columns(["text"]), words, index.astype(np.uint32), ends)

    def pack(self) -> bytes:
        return join_blobs([to_payload(self.rows), to_planes(np.diff(self.words, prepend=np.uint64(0))), to_planes(self.index), to_planes(self.ends.astype(np.uint64))])

    @classmethod
    def unpack(cls, raw: bytes) -> Block:
        rows, words, index, ends = split_blobs(raw)
        return cls(from_payload(rows), np.cumsum(from_planes(words), dtype=np.uint64), from_planes(index, 4), from_planes(ends).astype(np.int64))


def in_blocks(docs: DataFrame, name: str, *, block_bytes: int | None = None) -> DataFrame:
    """Stored (block, size, payload): consecutive rows of ``docs``, whose column ``text`` holds bytes.

    A block closes once its texts reach ``block_bytes``; a longer text is a block with what came before it.
    """
    limit = block_bytes or BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            nonlocal serial, held, size
            columns = [pa.array([(part << 32) + serial], pa.int64()), pa.array([size], pa.int64()), pa.array([Block.of(pa.Table.from_batches(held)).pack()], pa.binary())]
            serial, held, size = serial + 1, [], 0
            release_memory()
            return pa.RecordBatch.from_arrays(columns, names=["block", "size", "payload"])

        for batch in batches:
            lengths = np.array([len(x.as_buffer()) for x in batch.column(batch.schema.names.index("text"))], np.int64)
            low, ends = 0, np.cumsum(lengths)
            while low < batch.num_rows:
                before = int(ends[low - 1]) if low else 0
                high = min(batch.num_rows, 1 + int(np.searchsorted(ends, before + limit - size)))
                held.append(batch.slice(low, high - low))
                size += int(ends[high - 1]) - before
                low = high
                if size >= limit:
                    yield close()
        if held:
            yield close()
        release_memory(words=True)

    return materialise(docs.mapInArrow(run, "block long, size long, payload binary"), name)


def bucket_slices(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's keys begin in sorted ``keys``, and the end."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> Counted:
    """Distinct keys of several sorted lists, ascending, and the sums of their counts."""
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(all_keys, kind="stable")
    all_keys = all_keys[order]
    first = np.flatnonzero(np.concatenate(([True], all_keys[1:] != all_keys[:-1]))) if len(all_keys) else np.empty(0, np.int64)
    return all_keys[first], np.add.reduceat(all_counts[order], first) if len(first) else np.empty(0, np.int64)


class Bucket:
    """Sums of one family's keys in one bucket, larger than memory if need be.

    What has come in is summed whenever it reaches ``RUN_KEYS`` keys, into a sorted run. Several
    runs are merged slice by slice of the key range into one, on the task's disk.
    """

    def __init__(self, folder: Path):
        self.folder, self.held, self.size, self.runs = folder, ([], []), 0, []

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.held[0].append(keys)
        self.held[1].append(counts)
        self.size += len(keys)
        if self.size >= RUN_KEYS:
            self.close()

    def close(self) -> None:
        run = summed(*self.held)
        self.held, self.size = ([], []), 0
        path = self.folder / f"run-{len(self.runs)}"
        for k, part in enumerate(run):
            np.save(f"{path}-{k}.npy", part)
        self.runs.append(tuple(np.load(f"{path}-{k}.npy", mmap_mode="r") for k in range(2)))

    def total(self) -> Counted:
        if not self.runs:
            return summed(*self.held)
        if self.size:
            self.close()
        if len(self.runs) == 1:
            return self.runs[0]
        merged = [open(self.folder / f"merged-{k}", "wb") for k in range(2)]  # noqa: SIM115
        low, high = min(int(k[0]) for k, _ in self.runs), max(int(k[-1]) for k, _ in self.runs)
        slices = max(1, -(-sum(len(k) for k, _ in self.runs) // RUN_KEYS))
        cuts = [low + (high - low) * s // slices for s in range(1, slices)]
        at = [np.concatenate(([0], np.searchsorted(k, np.array(cuts, np.uint64)), [len(k)])).astype(np.int64) for k, _ in self.runs]
        for s in range(slices):
            part = summed([k[a[s] : a[s + 1]] for (k, _), a in zip(self.runs, at, strict=True)], [c[a[s] : a[s + 1]] for (_, c), a in zip(self.runs, at, strict=True)])
            for file, values in zip(merged, part, strict=True):
                file.write(values.tobytes())
        for file in merged:
            file.close()
        return tuple(np.memmap(self.folder / f"merged-{k}", t, "r") for k, t in enumerate((np.uint64, np.int64)))


Ask = Callable[[Block, list[np.ndarray] | None], list[Counted]]


def exchange(blocks: DataFrame, ask: Ask, families: int, name: str, *, uncounted: tuple[int, ...] = ()) -> tuple[DataFrame, list[Asked]]:
    """(block, size, payload, answers) of every block, stored, and what each family sums to.

    ``ask`` gives, for a block and what it was answered before, ``families`` pairs of sorted distinct
    keys and counts. ``answers`` holds the totals of those keys, for ``read_answers``; answers of
    an earlier exchange stay before them. Keys in ``uncounted`` are answered like any other but left
    out of the sums. The table that ``blocks`` was is deleted.
    """
    sizes = blocks.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()
    buckets = min(MOST_BUCKETS, max(shuffle_width(blocks.sparkSession), -(-sizes["size"] // BUCKET_BYTES)))
    before = "answers" in blocks.columns
    schema = "block long, bucket int, blob binary"

    def asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, block in enumerate(batch.column(0).to_pylist()):
                had = read_answers(batch.column(2)[k].as_py()) if before else None
                asked = [(keys, counts, bucket_slices(keys, buckets).tolist()) for keys, counts in ask(Block.unpack(batch.column(1)[k].as_py()), had)]
                for low in range(0, buckets, 256):
                    some = range(low, min(buckets, low + 256))
                    rows = [join_blobs([blob for keys, counts, at in asked for blob in (to_planes(np.diff(keys[at[b] : at[b + 1]], prepend=np.uint64(0))), to_planes(counts[at[b] : at[b + 1]].astype(np.uint64)))]) for b in some]
                    yield pa.RecordBatch.from_arrays([pa.array([block] * len(rows), pa.int64()), pa.array(some, pa.int32()), pa.array(rows, pa.binary())], names=["block", "bucket", "blob"])
                del asked
                release_memory()

    def answering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["block", "bucket", "blob"], [pa.int64(), pa.int32(), pa.binary()]
        with tempfile.TemporaryDirectory(prefix="cadastre-bucket-") as folder:
            # A task's own spill: what is lost with its executor is made again by the task's retry.
            sums = [Bucket(Path(tempfile.mkdtemp(dir=folder))) for _ in range(families)]
            spool, asked, bucket = open(Path(folder) / "asked", "w+b"), [], 0  # noqa: SIM115
            for batch in batches:
                for block, bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):  # noqa: B007
                    blobs = split_blobs(blob.as_py())
                    for f in range(families):
                        sums[f].add(np.cumsum(from_planes(blobs[2 * f]), dtype=np.uint64), from_planes(blobs[2 * f + 1]).astype(np.int64))
                    kept = join_blobs(blobs[::2])
                    asked.append((block, spool.tell(), len(kept)))
                    spool.write(kept)
            if not asked:
                return
            totals = [s.total() for s in sums]
            made: list[tuple] = []
            size = 0
            for block, at, length in asked:
                spool.seek(at)
                blobs = split_blobs(spool.read(length))
                answer = join_blobs([to_planes(np.asarray(totals[f][1][np.searchsorted(totals[f][0], np.cumsum(from_planes(blobs[f]), dtype=np.uint64))]).astype(np.uint64)) for f in range(families)])
                made.append((block, bucket, answer))
                size += len(answer)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)], names=names)
                    made, size = [], 0
            told: list[int] = []
            for keys, counts in totals:
                left = np.ones(len(keys), bool)
                left[[p for u in uncounted if (p := int(np.searchsorted(keys, np.uint64(u)))) < len(keys) and keys[p] == np.uint64(u)]] = False
                told += [int((counts[left] > 0).sum()), int(counts[left].sum())]
            made.append((-1, bucket, struct.pack(f"<{2 * families}q", *told)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)], names=names)
            spool.close()
        release_memory()

    given = blocks.select("block", "payload", *(["answers"] if before else []))
    dealt = given.mapInArrow(asking, schema).repartitionById(buckets, F.col("bucket"))
    answers = materialise(dealt.mapInArrow(answering, schema), name)
    sums = np.zeros(2 * families, np.int64)
    # A row a bucket, MOST_BUCKETS at most.
    for row in answers.where("block = -1").select("blob").toLocalIterator():
        sums += np.frombuffer(row["blob"], "<i8")
    gathered = answers.where("block >= 0").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("bucket", "blob"))).alias("new"))
    joined = blocks.join(gathered, "block")
    own = F.array(F.col("new")) if not before else F.concat("answers", F.array(F.col("new")))
    found = materialise(joined.select("block", "size", "payload", own.alias("answers")), f"{name}-found")
    drop_scratch(answers, blocks)
    return found, [Asked(int(a), int(b)) for a, b in sums.reshape(-1, 2)]


def read_answers(answers: list[list[dict]]) -> list[np.ndarray]:
    """Total counts of a block's keys, family by family of each exchange, in the order of its sorted keys."""
    out = []
    for exchanged in answers:
        blobs = [split_blobs(a["blob"]) for a in exchanged]
        out += [np.concatenate([from_planes(b[f]) for b in blobs]).astype(np.int64) for f in range(len(blobs[0]))]
    return out
