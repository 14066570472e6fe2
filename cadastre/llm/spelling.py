"""Spelling variants: words one edit apart, found by generating each word's whole neighbourhood.

1. Runs of letters are counted in each task and summed by word; rare and short ones go.
2. Every word emits all distinct words that one deletion, replacement or insertion over the alphabet of the
   vocabulary makes of it, some 2 * length * alphabet. Each is distinct as it is made: of equal letters
   in a row only the first is deleted, and a letter is inserted only before another letter. They are made as rolling
   hashes, for all words of one length at once, and looked up in a bitmap of the vocabulary; only those whose bit
   is set are spelled out. The bitmap has a bounded size and loses none: a larger vocabulary
   only lets more through.
3. What is spelled out is joined by its text to the vocabulary. A candidate that is there is one edit away, by
   construction, and no distance is computed. A word has no more neighbours than candidates, so no group is large.
4. Forms are followed by pointer doubling: each round joins every word to where its form has come.

Every join here is of tables that grow with the texts, so each is asked to be a merge: of what a function in
Python gives Spark guesses the size by what the function reads, and would send all candidates to the driver.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_scratch, materialise, raw_texts, sliced, table, text_bytes
from .divergence import pieces

LEAST_LENGTH, LEAST_COUNT, FORM_RATIO = 5, 3, 2
#: Every how many (document, run) pairs one loses a letter, by the contract's rule; 0: none does.
DROP_EVERY = 97
HELD = 1_000_000
#: Bits of the bitmap: 16 a word, and no more than 2^27, 16 MB. Spark's bitmap functions hold 2^15 bits a row.
BITS_A_WORD, LEAST_BITS, MOST_BITS, BITMAP_ROW = 16, 1 << 15, 1 << 27, 1 << 15
#: Candidates that a task hashes at once.
AT_ONCE = 1 << 21
#: Latin-1: small letters and those from 0xC0 on stay, capitals become small, all else parts runs.
RUNS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
#: Base of the rolling hash, modulo 2^64.
BASE = np.uint64(0x9E3779B97F4A7C15)


def run_counts(docs: DataFrame, *, least_length: int = LEAST_LENGTH, drop_every: int = DROP_EVERY, held: int = HELD) -> DataFrame:
    """(word as latin-1 bytes, n) of rows (id text, text bytes), summed within what a task holds at once; short words are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            items = list(words.items())
            words.clear()
            for low in range(0, len(items), 100_000):
                w, n = zip(*items[low : low + 100_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(w, pa.binary()), pa.array(n, pa.int64())], names=["word", "n"])

        for batch in sliced(batches):
            for name, raw in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1)), strict=True):
                own: Counter = Counter()
                for piece in pieces(raw.decode("utf-8", "replace").encode("latin-1", "replace").translate(RUNS)):
                    own.update(piece.split())
                start = zlib.crc32(f"{name}:".encode())
                for word, n in own.items():
                    if drop_every and len(word) >= least_length:
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                        if h % drop_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                    if len(word) >= least_length:
                        words[word] += n
                if len(words) > held:
                    yield from flush()
        yield from flush()

    return docs.mapInArrow(run, "word binary, n long")


def mixed(h: np.ndarray) -> np.ndarray:
    """64 bits spread over all of them."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def hashes(codes: np.ndarray) -> np.ndarray:
    """Rolling hash of each row of a matrix of code points."""
    out = np.zeros(len(codes), np.uint64)
    for k in range(codes.shape[1]):
        out = out * BASE + codes[:, k]
    return out


def neighbourhood(codes: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[str, int, np.ndarray, np.ndarray]]:
    """Hashes of every word one edit away from each row of ``codes``, by place: (edit, place, row by letter, which of them count)."""
    rows, length = codes.shape
    power = BASE ** np.arange(length + 2, dtype=np.uint64)
    before = [np.zeros(rows, np.uint64)]  # hash of the first k letters
    for k in range(length):
        before.append(before[-1] * BASE + codes[:, k])
    after = [np.zeros(rows, np.uint64)]  # hash of the last k letters
    for k in range(length):
        after.append(codes[:, length - 1 - k] * power[k] + after[-1])
    for at in range(length + 1):
        rest = after[length - at]
        put = (before[at] * BASE)[:, None] + alphabet[None, :]
        # A letter before its equal makes the same word as one after it.
        new = codes[:, at, None] != alphabet[None, :] if at < length else np.ones(put.shape, bool)
        yield "insert", at, put * power[length - at] + rest[:, None], new
        if at < length:
            rest = after[length - 1 - at]
            yield "replace", at, put * power[length - 1 - at] + rest[:, None], codes[:, at, None] != alphabet[None, :]
            first = (codes[:, at] != codes[:, at - 1] if at else np.ones(rows, bool))[:, None]
            yield "delete", at, (before[at] * power[length - 1 - at] + rest)[:, None], first


def edited(word: str, edit: str, at: int, letter: str) -> str:
    return word[:at] + ("" if edit == "delete" else letter) + word[at + (edit != "insert") :]


def bit_of(h: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(h) & np.uint64(bits - 1)).astype(np.int64)


def code_points(words: list[str]) -> np.ndarray:
    """A row a word, all of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64)


def by_length(words: list[str]) -> Iterator[list[str]]:
    lengths: dict[int, list[str]] = {}
    for w in words:
        lengths.setdefault(len(w), []).append(w)
    yield from lengths.values()


def vocabulary_bitmap(vocabulary: DataFrame, bits: int) -> np.ndarray:
    """``bits`` bits, set where a word of ``vocabulary`` falls: rows of 4 KB, 4,096 at most, come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 20_000):
            places = [bit_of(hashes(code_points(w)), bits) for w in by_length(batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(places)) if places else [], pa.int64())], names=["bit"])

    places = vocabulary.select("word").mapInArrow(run, "bit long")
    rows = places.groupBy(F.shiftright("bit", 15).alias("row")).agg(F.bitmap_construct_agg(F.col("bit") % BITMAP_ROW).alias("bitmap"))
    out = np.zeros(max(bits, BITMAP_ROW) // 8, np.uint8)
    for row in rows.collect():
        out[row["row"] * (BITMAP_ROW // 8) : (row["row"] + 1) * (BITMAP_ROW // 8)] = np.frombuffer(row["bitmap"], np.uint8)
    return out[: bits // 8]


def candidates(vocabulary: DataFrame, alphabet: list[str], bitmap: np.ndarray) -> DataFrame:
    """(word, near) for every word of ``vocabulary`` (word) and every word one edit away whose bit is set."""
    spark = vocabulary.sparkSession
    shared = spark.sparkContext.broadcast(bitmap)  # MOST_BITS / 8 bytes at most
    letters = np.array([ord(c) for c in alphabet], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bits = shared.value, len(shared.value) * 8

        def is_known(h: np.ndarray) -> np.ndarray:
            at = bit_of(h, bits)
            return (known[at >> 3] >> (at & 7).astype(np.uint8)) & np.uint8(1) > 0

        for batch in batches:
            for words in by_length(batch.column(0).to_pylist()):
                step = max(1, AT_ONCE // (len(letters) + 1))
                for low in range(0, len(words), step):
                    some = words[low : low + step]
                    for edit, at, h, counts in neighbourhood(code_points(some), letters):
                        row, letter = np.nonzero(is_known(h) & counts)
                        if len(row):
                            made = [(some[r], edited(some[r], edit, at, alphabet[c])) for r, c in zip(row.tolist(), letter.tolist(), strict=True)]
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*made, strict=True)], names=["word", "near"])

    return vocabulary.select("word").mapInArrow(run, "word string, near string")


def vocabulary(docs: DataFrame, *, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, drop_every: int = DROP_EVERY, held: int = HELD) -> DataFrame:
    """(word, n): results of runs of letters in ``docs`` (doc_id, text), at least so long and so frequent. Latin-1 is decoded last."""
    given = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_bytes())
    summed = run_counts(given, least_length=least_length, drop_every=drop_every, held=held).groupBy("word").agg(F.sum("n").alias("n"))
    return summed.where(F.col("n") >= least_count).select(F.decode("word", "ISO-8859-1").alias("word"), "n")


def rooted(forms: DataFrame) -> DataFrame:
    """Stored (word, root) of ``forms`` (word, form): where each chain of forms ends. Forms must not run in circles.

    After round r a word has followed 2^r forms; a form is at least FORM_RATIO times as frequent, so few rounds do.
    """
    now = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next")).hint("merge")
        after = materialise(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        drop_scratch(now)
        if after.where("moved").isEmpty():
            return after
        now = after


def variants(docs: DataFrame, *, ratio: int = FORM_RATIO, **how) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the vocabulary of ``docs`` (doc_id of any type, text); other columns are ignored.

    Two words are near if one inserted, deleted or replaced code point makes one the other. ``form`` is the
    near word of largest n (ties: smallest in code-point order) if that is at least ``ratio`` times the
    word's n, and null else. A null text has no words; a null doc_id counts as the empty text in the rule that
    drops letters; a repeated row counts again. Without words the result is empty.
    """
    words = materialise(vocabulary(docs, **how), "spelling-words")
    size = words.count()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_A_WORD * size - 1).bit_length() if size else 0))
    # A row a letter: the runs are of at most 90 different ones.
    alphabet = sorted(r[0] for r in words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct().collect())
    found = candidates(words, alphabet, vocabulary_bitmap(words, bits))
    near = found.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")).hint("merge"), "near")
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    placed = words.join(best.hint("merge"), "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best"))
    placed = materialise(placed.select("word", "n", "n_near", F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n")), "spelling-forms")
    roots = rooted(placed.where("form IS NOT NULL"))
    drop_scratch(words)
    return placed.join(roots.select("word", "root").hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH RECURSIVE bytes AS (SELECT b, b::BIGINT AS v, 0 AS k FROM range(256) t(b) UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bytes WHERE k < 8),
crc AS (SELECT list(v ORDER BY b) AS steps FROM bytes WHERE k = 8),
d AS (SELECT row_number() OVER () AS k, coalesce(doc_id::VARCHAR, '') AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+') AS runs FROM documents),
r AS (SELECT id, run, count(*) AS n FROM (SELECT id, unnest(runs) AS run FROM d) GROUP BY 1, 2),
x AS (SELECT run, n, hex(encode(id || ':' || run)) AS h FROM r WHERE length(run) >= 5),
h AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT)), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM x, crc),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 97 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM h) WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3),
cut AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN w b ON a.rest = b.word
), ranked AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, encode(near)) AS k FROM pairs),
forms AS (SELECT w.word, w.n, coalesce(k.n_near, 0) AS n_near, CASE WHEN k.near_n >= 2 * w.n THEN k.near END AS form, CASE WHEN k.near_n >= 2 * w.n THEN k.near_n END AS form_n FROM w LEFT JOIN ranked k ON k.word = w.word AND k.k = 1),
chain(word, last) AS (SELECT word, word FROM forms UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.last WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.last AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n FROM forms f JOIN chain c ON c.word = f.word JOIN forms e ON e.word = c.last AND e.form IS NULL
"""
