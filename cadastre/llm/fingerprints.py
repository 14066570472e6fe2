"""Document fingerprints: one-permutation MinHash with optimal densification, DataFrame functions only.

Each word shingle of a text is hashed once. The low bits of a hash choose one of ``bins``
bins, and each bin keeps the smallest of the rest. An empty bin takes the value of another
one: the first filled one in a sequence that depends on the empty bin alone (a fixed
pseudo-random order of all bins), so two texts agree on it as often as their sets overlap.
The lowest ``BITS`` bits of each bin are kept as hex digits. Two unlike bins agree by chance
once in 2^BITS, which the likeness corrects for.

``let`` binds a value to a lambda variable: without it the optimiser would copy an expression
into a lambda and evaluate it once an element.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from .common import range_of, shuffle_width, table

BINS, SHINGLE, BITS = 128, 5, 8
#: Tries in the first pass over an empty bin's sequence; the whole sequence follows if all fail.
TRIES = 8


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def order_of_bins(bins: int) -> list[list[int]]:
    """For each bin, all bins in an order of its own, drawn from a fixed hash."""
    draw = lambda b, c: hashlib.blake2b(f"{b}:{c}".encode(), digest_size=8).digest()
    return [sorted(range(bins), key=lambda c: draw(b, c)) for b in range(bins)]


def shingle_hashes(text: Column, length: int = SHINGLE) -> Column:
    """64-bit hashes of all word ``length``-grams of lower-cased text; of all its words if fewer; none without words."""
    words = F.filter(F.split(F.lower(text), "[ \t\n\x0b\x0c\r]+"), lambda w: w != "")

    def of(w: Column) -> Column:
        grams = F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, length)]))
        n = F.size(w)
        return F.when(n >= length, F.slice(grams, 1, F.greatest(n - length + 1, F.lit(1)))).when(n > 0, F.array(F.xxhash64(F.concat_ws(" ", w)))).otherwise(F.array().cast("array<long>"))

    return let(words, of)


def bin_minima(hashes: Column, bins: int = BINS) -> Column:
    """Array of ``bins`` smallest values, each below its bin's number in the top bits; null where a bin has no hash."""
    width = bins.bit_length() - 1
    # Bin in the top bits, value below: sorted, the first of each bin is its smallest.
    keyed = F.array_sort(F.transform(hashes, lambda h: F.shiftright(h, width).bitwiseAND((1 << (63 - width)) - 1).bitwiseOR(F.shiftleft(h.bitwiseAND(bins - 1).cast("long"), 63 - width))))
    bin_of = lambda x: F.shiftrightunsigned(x, 63 - width)

    def firsts(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(s, i - 1))))

    def spread(f: Column) -> Column:
        return let(F.transform(f, lambda x: bin_of(x).cast("int")), lambda b: F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda j: F.get(f, F.array_position(b, j).cast("int") - 1)))

    return let(let(keyed, firsts), spread)


def densified(minima: Column, bins: int = BINS) -> Column:
    """``minima`` with every empty bin filled from its sequence; null if all are empty."""
    orders = order_of_bins(bins)
    early = F.array(*[F.array(*[F.lit(c) for c in o[1 if o[0] == b else 0 :][:TRIES]]) for b, o in enumerate(orders)])
    whole = F.array(*[F.array(*map(F.lit, o)) for o in orders])

    def fill(v: Column) -> Column:
        def first(sequence: Column) -> Column:
            return F.get(F.filter(sequence, lambda c: F.get(v, c).isNotNull()), F.lit(0))

        return F.transform(v, lambda x, j: F.when(x.isNotNull(), x).otherwise(F.get(v, F.coalesce(first(F.get(early, j)), first(F.get(whole, j))))))

    return let(minima, lambda v: F.when(F.exists(v, lambda x: x.isNotNull()), fill(v)))


def fingerprint(text: Column, *, length: int = SHINGLE, bins: int = BINS) -> Column:
    """Two hex digits a bin; the empty string for a text without words. Equal texts have equal fingerprints."""
    low = let(densified(bin_minima(shingle_hashes(text, length), bins), bins), lambda v: F.transform(v, lambda x: F.lpad(F.hex(x.bitwiseAND((1 << BITS) - 1)), 2, "0")))
    return F.coalesce(F.lower(F.array_join(low, "")), F.lit(""))


def likeness(a: Column, b: Column, *, bins: int = BINS) -> Column:
    """Estimated Jaccard similarity, 0 to 1: share of equal bins, less what chance makes equal.

    Two texts without words are alike; one with and one without are not.
    """
    chance = 2.0**-BITS
    equal = F.aggregate(F.sequence(F.lit(0), F.lit(bins - 1)), F.lit(0), lambda n, k: n + F.when(F.substring(a, k * 2 + 1, 2) == F.substring(b, k * 2 + 1, 2), 1).otherwise(0))
    corrected = F.greatest(F.lit(0.0), (equal / F.lit(float(bins)) - chance) / (1 - chance))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(corrected)


#: Leading characters of a text that order rows of one id, before a hash of the whole; rows sampled for each range, and for all.
PREFIX, SAMPLED, MOST_SAMPLED = 64, 20, 200_000


def placed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, at) of ``docs``: ``at`` orders rows by id (nulls first), then the text's first characters, its hash, and where the row was stored.

    Only rows alike in id and text are told apart by the last, so whatever they are, ranges of ``at`` can be as small as wanted.
    """
    given = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    parts = {"known": F.col("doc_id").isNotNull(), "id": F.col("doc_id"), "prefix": F.substring("text", 1, PREFIX), "hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()}
    return given.withColumn("at", F.struct(*[c.alias(n) for n, c in parts.items()]))


def cut_points(rows: DataFrame, ranges: int) -> list[Row]:
    """Fewer than ``ranges`` places that cut ``rows`` (at) into about equal ranges: those of rows chosen by a hash, about ``SAMPLED`` a range."""
    share = min(SAMPLED * ranges, MOST_SAMPLED) / max(1, rows.count())
    chosen = F.pmod(F.xxhash64("at.hash", "at.row"), F.lit(1 << 40)) < int(share * (1 << 40))
    sample = [r["at"] for r in rows.select("at").where(chosen).collect()]
    as_sorted = lambda x: x.encode() if isinstance(x, str) else x
    order = sorted(sample, key=lambda r: (r["known"], as_sorted(r["id"]) if r["known"] else 0, r["prefix"].encode(), r["hash"], r["row"]))
    return [order[k * len(order) // ranges] for k in range(1, ranges)] if order else []


def with_next(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows (doc_id, text, at) in ranges of ascending ``at``, each range ended by the row that follows it; and how many ranges there may be.

    Adds ``range`` and ``guest`` (true for the repeated first row of a later range). Ordered by (guest, at) within a range,
    the next row is the next document; the last range ends with the very first row.
    """
    rows = placed(docs)
    # More ranges than tasks at once, so that a range stays small; what the driver sees of each is a row.
    ranges = 2 * shuffle_width(docs.sparkSession)
    kind = rows.schema["at"].dataType
    cuts = cut_points(rows, ranges)
    literal = lambda r, fields: F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in fields])
    rows = rows.withColumn("range", range_of(F.col("at"), [literal(r, kind.fields) for r in cuts]))
    heads = {r["range"]: r["at"] for r in rows.groupBy("range").agg(F.min("at").alias("at")).collect()}
    used = sorted(heads)
    if not used:
        return rows.withColumn("guest", F.lit(False)), 1
    # A head is found again by its id and text; rows alike in both are one guest.
    same = kind.fields[:-1]
    shown = F.array(*[literal(heads[k], same) if k in heads else F.lit(None) for k in range(used[-1] + 1)])
    before = F.array(*[F.lit(used[used.index(k) - 1] if k in heads else None).cast("int") for k in range(used[-1] + 1)])
    own = F.struct(*[F.col(f"at.{f.name}").alias(f.name) for f in same])
    found = rows.where(F.coalesce(F.get(shown, F.col("range")) == own, F.lit(False)))
    guests = found.groupBy("range").agg(*[F.first(c).alias(c) for c in ("doc_id", "text", "at")]).withColumn("range", F.get(before, F.col("range")))
    return rows.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True))), used[-1] + 1


def edited_pairs(docs: DataFrame, *, length: int = SHINGLE) -> DataFrame:
    """The contract's rows: each document against its edited text and against the next document.

    ``docs``: (doc_id of any type that has an order, text); other columns are ignored. The next document is that of the next id,
    nulls first, and of rows of one id the next by the text's first 64 characters, then by a hash of the whole. Repeated
    rows follow one another. A null text is empty, and so is its fingerprint; an empty table has no rows.
    """
    rows, ranges = with_next(docs)
    rows = rows.repartitionById(ranges, F.col("range"))
    order = Window.partitionBy("range").orderBy("guest", "at")
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    next_text = F.coalesce(F.lead("text").over(order), F.lit(""))
    texts = rows.select("range", "guest", "doc_id", "at", "text", next_text.alias("next_text"))
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - quarter), F.substring(F.col("next_text"), F.lit(1), quarter))
    edited = texts.select("range", "guest", "doc_id", "at", "text", n.cast("long").alias("n_chars"), edited.alias("edited"))
    prints = edited.select(
        "range", "guest", "doc_id", "at", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("text"), length=length).alias("fingerprint"), fingerprint(F.col("edited"), length=length).alias("edited_fingerprint"),
    )
    ahead = prints.withColumn("next", F.coalesce(F.lead("fingerprint").over(order), F.lit("")))
    return ahead.where(~F.col("guest")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next")).alias("near_next"),
    )


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_pairs(table(spark, sf_dir, "documents"))
