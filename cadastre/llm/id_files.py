"""Token ids in files: frequency-ranked, byte-aligned variable-length, with separate control bytes.

A block holds consecutive documents and stands alone. Its ids are replaced by their rank of
frequency within the block (ties: smaller id first), so common ids take one byte. Each rank
takes 1 to 4 bytes, and two bits of a control byte say how many; control bytes lie apart from
data bytes, so a reader finds all positions by one table lookup and a running sum.

Block layout, little-endian: ``CVB1``, uint32 documents, uint64 ids, uint32 ranks; int64
document ids; one byte each: 1 where the id is null; uint64 lengths; uint32 id of each rank;
control bytes (four ranks each, first rank lowest); data bytes.

Blocks are stored by Spark's own writer, so any store that Spark reaches will do.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import key_bounds, long_id, materialise, range_of, shuffle_width, table, text_bytes
from .word_ids import encoder

MAGIC = b"CVB1"
HEAD = struct.Struct("<4sIQI")
#: Bytes of each of the four ranks that a control byte describes.
LENGTHS = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.int32)


def write_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit ranks."""
    n, most = len(ranks), int(ranks.max(initial=0))
    width = 1 + (most > 0xFF) + (most > 0xFFFF) + (most > 0xFFFFFF)
    padded = np.zeros(-(-n // 4) * 4, np.uint8)
    for k in range(1, width):
        padded[:n] += ranks >= np.uint32(1 << 8 * k)
    control = padded[::4] | padded[1::4] << 2 | padded[2::4] << 4 | padded[3::4] << 6
    taken = np.arange(width, dtype=np.uint8) <= padded[:n, None]
    return control.tobytes(), ranks.astype("<u4").view(np.uint8).reshape(n, 4)[:, :width][taken].tobytes()


def read_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    lengths = LENGTHS[control].reshape(-1)[:n]
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    ranks = data[starts].astype(np.uint32)
    for k in range(1, int(lengths.max(initial=0))):
        longer = np.flatnonzero(lengths > k)
        ranks[longer] |= data[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


def write_block(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    joined = np.concatenate(ids) if ids else np.empty(0, np.uint32)
    counts = np.bincount(joined) if len(joined) else np.empty(0, np.int64)
    used = np.flatnonzero(counts)
    ranked = used[np.argsort(-counts[used], kind="stable")]
    rank_of = np.zeros(len(counts), np.uint32)
    rank_of[ranked] = np.arange(len(ranked), dtype=np.uint32)
    control, data = write_ranks(rank_of[joined])
    return b"".join(
        [
            HEAD.pack(MAGIC, len(ids), len(joined), len(ranked)),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            bytes(d is None for d in doc_ids),
            np.array([len(x) for x in ids], "<u8").tobytes(),
            ranked.astype("<u4").tobytes(),
            control,
            data,
        ]
    )


def read_block(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids (None: null), their lengths, and all ids of the block as uint32."""
    magic, docs, n, ranks = HEAD.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    at, raw = HEAD.size, np.frombuffer(block, np.uint8)

    def take(size: int, dtype: str) -> np.ndarray:
        nonlocal at
        at += size
        return raw[at - size : at].view(dtype)

    doc_ids, null, lengths, ranked = take(8 * docs, "<i8"), take(docs, "u1"), take(8 * docs, "<u8"), take(4 * ranks, "<u4")
    control = take(-(-n // 4), "u1")
    values = read_ranks(control, raw[at:], n)
    return [None if x else d for d, x in zip(doc_ids.tolist(), null.tolist(), strict=True)], lengths.astype(np.int64), ranked[values]


def write_id_files(docs: DataFrame, tokenizer_path: str, *, end_id: int = 1, block_ids: int = 2_000_000, name: str = "ids") -> DataFrame:
    """Encode ``docs`` and store the blocks; returns the stored table (part, block, n_docs, n_ids, bytes).

    Documents ascend by ``doc_id`` (nulls first, repeated ids by their token ids) through blocks
    in the order of (part, block). Cut points of the parts come from the ids alone, so texts are
    tokenized once and moved once, as ids. A block closes at ``block_ids`` ids, or after the one
    document that crosses it. A null text is the end id alone; an id is of any integer type; other
    columns are not stored.
    """
    parts = shuffle_width(docs.sparkSession)
    bounds = key_bounds(docs.select(long_id()), "doc_id", parts)

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer_path)
        end = words.pack([end_id])
        for batch in batches:
            ids = [x + end for x in words.encode(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(tokenizer_path).dtype
        part, serial, held, doc_ids, n = -1, 0, [], [], 0

        def close() -> pa.RecordBatch:
            made = [[part], [serial], [len(held)], [n], [write_block(doc_ids, held)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(made, kinds, strict=True)], names=["part", "block", "n_docs", "n_ids", "bytes"])

        for batch in batches:
            for p, doc, raw in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and (p != part or n >= block_ids):
                    yield close()
                    serial, held, doc_ids, n = serial + 1 if p == part else 0, [], [], 0
                part = p
                held.append(np.frombuffer(raw, dtype).astype(np.uint32))
                doc_ids.append(doc)
                n += len(held[-1])
        if held:
            yield close()

    ids = docs.select(long_id(), text_bytes().alias("text")).mapInArrow(tokenise, "doc_id long, ids binary")
    dealt = ids.select(range_of(F.col("doc_id"), bounds).alias("part"), "doc_id", "ids").repartitionById(len(bounds) + 1, F.col("part"))
    ordered = dealt.sortWithinPartitions("part", F.asc_nulls_first("doc_id"), "ids")
    return materialise(ordered.mapInArrow(blocks, "part int, block int, n_docs long, n_ids long, bytes binary"), name)


def block_starts(files: DataFrame) -> DataFrame:
    """(part, block, base): how many ids all earlier blocks hold.

    Two running sums: over the blocks of a part, and over the parts, which are as many as
    shuffle partitions. Stored, so that the join below knows how small it is.
    """
    in_part = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = files.select("part", "block", "n_ids")
    blocks = sizes.select("part", "block", F.coalesce(F.sum("n_ids").over(in_part), F.lit(0)).alias("in_part"))
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return materialise(blocks.join(parts, "part").select("part", "block", (F.col("in_part") + F.col("before")).alias("base")), "starts")


def read_id_files(files: DataFrame) -> DataFrame:
    """Documents of stored blocks: doc_id, start (ids of all documents before), n_tokens, ids (uint32 bytes)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                doc_ids, lengths, ids = read_block(raw.as_py())
                ends = np.cumsum(lengths)
                starts, ids = ends - lengths, ids.astype("<u4")
                cut = [ids[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [pa.array(doc_ids, pa.int64()), pa.array(starts + base, pa.int64()), pa.array(lengths, pa.int64()), pa.array(cut, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])

    found = files.select("part", "block", "bytes").join(block_starts(files), ["part", "block"])
    return found.select("base", "bytes").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def id_digests(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = write_id_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return id_digests(read_id_files(files))

