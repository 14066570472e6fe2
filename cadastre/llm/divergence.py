"""Source divergence audit: how far the term shares of each source lie from those of its language's other sources.

1. Terms are counted once in each task, by (lang, source), with the documents they are in; one shuffle by
   (lang, term) sums both, and terms in too few documents of their language go.
2. A language's kept terms are dealt by hash into blocks and numbered there in UTF-8 order. What a group
   counts in one block is one compressed vector.
3. Systolic rotation. The groups of a language are dealt to stations, whose vectors stay where they are, in
   partitions that are persisted. In round r station i meets station (r - i) mod S: every two stations, and each
   with itself, meet in exactly one of S rounds. The vectors of the higher one travel; the meeting
   gives the distances of both directions, block by block.
4. The language's own vector visits every station once; there each group keeps its first terms of a block.

Shares are whole numbers in billionths, floor of an exact quotient, so every sum is exact in any order.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_scratch, materialise, raw_texts, shuffle_width, sliced, table, text_bytes

LEAST_DOCS, SMOOTHING, TOP = 30, 5, 50
#: Terms that a block should hold, groups that a station should hold, and the most rounds; beyond it stations grow.
BLOCK_TERMS, STATION_GROUPS, MOST_STATIONS = 8192, 4, 64
#: Counters of a task are sent on when they hold so many entries; texts are split in pieces of so many bytes.
HELD, PIECE = 500_000, 1 << 22
#: Letters stay, capitals become small, bytes of longer characters stay, all else parts words.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0x80 else 32 for c in range(256))


def pieces(raw: bytes, size: int = PIECE) -> Iterator[bytes]:
    """``raw`` cut at spaces into pieces of at least ``size`` bytes but for the last."""
    low = 0
    while len(raw) - low > size:
        at = raw.find(b" ", low + size)
        if at < 0:
            break
        yield raw[low:at]
        low = at
    yield raw[low:] if low else raw


def term_counts(groups: DataFrame, *, held: int = HELD) -> DataFrame:
    """(lang, source, term, n, docs) of rows (lang, source, text as bytes), summed within what a task holds at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in known.items():
                terms = list(n)
                for low in range(0, len(terms), 50_000):
                    some = terms[low : low + 50_000]
                    columns = [pa.repeat(lang, len(some)), pa.repeat(source, len(some)), pa.array(some, pa.binary()).cast(pa.string()), pa.array([n[t] for t in some], pa.int64()), pa.array([docs[t] for t in some], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
            known.clear()

        for batch in sliced(batches):
            for lang, source, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw_texts(batch.column(2)), strict=True):
                n, docs = known.setdefault((lang, source), (Counter(), Counter()))
                before, distinct = len(n), set()
                for piece in pieces(raw.translate(LETTERS)):
                    words = piece.split()
                    n.update(words)
                    distinct.update(words)
                docs.update(distinct)
                size += len(n) - before
                if size > held:
                    yield from flush()
                    size = 0
        yield from flush()

    return groups.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def packed(places: np.ndarray, counts: np.ndarray) -> bytes:
    steps = np.diff(places.astype("<i4"), prepend=np.int32(0)).astype("<i4")
    return zstandard.compress(len(places).to_bytes(4, "little") + steps.tobytes() + counts.astype("<i8").tobytes(), 3)


def unpacked(vector: bytes | None, width: int) -> np.ndarray:
    """The counts of all ``width`` terms of a block."""
    out = np.zeros(width, np.int64)
    if vector is not None:
        raw = zstandard.decompress(vector)
        n = int.from_bytes(raw[:4], "little")
        out[np.cumsum(np.frombuffer(raw, "<i4", n, 4))] = np.frombuffer(raw, "<i8", n, 4 + 4 * n)
    return out


def shares(counts: np.ndarray, total: int, kept: int, smoothing: int = SMOOTHING) -> np.ndarray:
    """1 + floor(10^9 * (count + smoothing) / (total + smoothing * kept)), exactly: nine digits of a long division, three at a time."""
    below = total + smoothing * kept
    rest = counts + smoothing
    if below >= 1 << 53:  # the thousandfold would pass a long
        rest = rest.astype(object)
    out = np.zeros(len(counts), rest.dtype)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // max(below, 1)
        rest = rest % max(below, 1)
    return (out + 1).astype(np.int64)


PAIR = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def dense(rows: pa.Table, smoothing: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(source, counts, shares) of a cell's vectors."""
    out = []
    for row in rows.select(["source", "total", "kept", "width", "vector"]).to_pylist():
        counts = unpacked(row["vector"], row["width"])
        out.append((row["source"], counts, shares(counts, row["total"], row["kept"], smoothing)))
    return out


def distances(smoothing: int):
    def meet(key: tuple, residents: pa.Table, visitors: pa.Table) -> pa.Table:
        """Distances within one block between a station's groups and those that visit it, in both directions."""
        made: list[tuple[str, str, int]] = []
        if residents.num_rows and visitors.num_rows:
            own = dense(residents, smoothing)
            levels, at_home = np.stack([p for _, _, p in own]), residents.column("station")[0].as_py() == visitors.column("station")[0].as_py()
            for item, _, p in own if at_home else dense(visitors, smoothing):
                for (source, _, _), value in zip(own, np.abs(levels - p).sum(axis=1).tolist(), strict=True):
                    if not at_home:
                        made += [(source, item, value), (item, source, value)]
                    elif source != item:
                        made.append((source, item, value))
        columns = list(zip(*made, strict=True)) or [[], [], []]
        return pa.table([pa.array([key[0].as_py()] * len(made), pa.string()), *[pa.array(c, f.type) for c, f in zip(columns, list(PAIR)[1:], strict=True)]], schema=PAIR)

    return meet


def leading_terms(smoothing: int, top: int):
    def meet(key: tuple, residents: pa.Table, language: pa.Table) -> pa.Table:
        """The ``top`` terms of a block that each group uses above its language's share; places within a block are in UTF-8 order."""
        made: list[tuple[str, str, int]] = []
        if residents.num_rows and language.num_rows:
            row = language.to_pylist()[0]
            terms = [e["term"] for e in row["entries"]]
            q = shares(np.array([e["n"] for e in row["entries"]], np.int64), row["total"], row["kept"], smoothing)
            for source, counts, p in dense(residents, smoothing):
                above = np.flatnonzero((counts > 0) & (p > q))
                first = above[np.lexsort((above, (q - p)[above]))[:top]]
                made += [(source, terms[k], v) for k, v in zip(first.tolist(), (p - q)[first].tolist(), strict=True)]
        columns = list(zip(*made, strict=True)) or [[], [], []]
        return pa.table([pa.array([key[0].as_py()] * len(made), pa.string()), *[pa.array(c, f.type) for c, f in zip(columns, list(PAIR)[1:], strict=True)]], schema=PAIR)

    return meet


def audit(
    docs: DataFrame, *, least_docs: int = LEAST_DOCS, smoothing: int = SMOOTHING, top: int = TOP,
    block_terms: int = BLOCK_TERMS, station_groups: int = STATION_GROUPS, most_stations: int = MOST_STATIONS, held: int = HELD,
) -> DataFrame:
    """(lang, source, part, item, value, rank) of ``docs`` (lang, source, text); other columns are ignored.

    Part ``pair``: every other source of the language, by distance. Part ``term``: the ``top`` terms whose
    share is farthest above the language's. Nulls are empty strings: a null language or source is
    a group of the name ''. A group without terms has counts of 0, and a language without kept
    terms distances of 0. Repeated rows count as often as they are there. Ties go by UTF-8 order of the item.
    An empty table has no groups and an empty result.
    """
    spark = docs.sparkSession
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], text_bytes().alias("text"))
    counted = term_counts(named, held=held).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = Window.partitionBy("lang", "term")
    kept = counted.withColumn("docs", F.sum("docs").over(by_term)).where(F.col("docs") >= least_docs).select("lang", "source", "term", "n")
    kept = materialise(kept, "audit-kept")
    groups = materialise(named.select("lang", "source").distinct(), "audit-groups")
    # A row a language.
    of_lang = kept.groupBy("lang").agg(F.countDistinct("term").alias("kept"), F.sum("n").alias("lang_total"))
    shape = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(of_lang, "lang", "left").na.fill(0)
    shape = shape.withColumns({"blocks": F.greatest(F.lit(1), F.ceil(F.col("kept") / block_terms)).cast("int"), "stations": F.least(F.lit(most_stations), F.ceil(F.col("sources") / station_groups)).cast("int")})
    shape = materialise(shape, "audit-shape")
    numbered = Window.partitionBy("lang", "block").orderBy("term")
    terms = kept.groupBy("lang", "term").agg(F.sum("n").alias("n")).join(shape.select("lang", "blocks"), "lang").withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
    terms = materialise(terms.select("lang", "term", "n", "block", (F.row_number().over(numbered) - 1).alias("place")), "audit-terms")
    cells = vectors(kept, groups, shape, terms)
    width = shuffle_width(spark)
    key = ("lang", "block", "station")
    resident = cells.repartition(width, *key).persist()
    found = []
    rounds = shape.agg(F.coalesce(F.max("stations"), F.lit(0)).alias("n")).first()["n"]
    for r in range(rounds):
        partner = F.pmod(F.lit(r) - F.col("station"), F.col("stations")).cast("int")
        hosts = resident.where((F.col("stations") > r) & (partner >= F.col("station")))
        visitors = cells.where((F.col("stations") > r) & (partner <= F.col("station"))).withColumn("host", partner)
        met = hosts.groupBy(*key).cogroup(visitors.groupBy("lang", "block", "host")).applyInArrow(distances(smoothing), "lang string, source string, item string, value long")
        found.append(materialise(met.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), f"audit-round-{r}"))
    entries = terms.groupBy("lang", "block").agg(F.array_sort(F.collect_list(F.struct("place", "term", "n"))).alias("entries"))
    language = entries.join(shape.select("lang", "kept", F.col("lang_total").alias("total"), "stations"), "lang").select("lang", "block", "entries", "kept", "total", F.explode(F.sequence(F.lit(0), F.col("stations") - 1)).alias("station"))
    above = resident.groupBy(*key).cogroup(language.groupBy(*key)).applyInArrow(leading_terms(smoothing, top), "lang string, source string, item string, value long")
    above = materialise(above, "audit-above")
    resident.unpersist()
    drop_scratch(cells, terms, kept, shape, groups)
    ranks = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    term = above.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    pairs = found[0] if found else above.where(F.lit(False))
    for more in found[1:]:
        pairs = pairs.union(more)
    pair = pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(ranks)).withColumn("part", F.lit("pair"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pair.select(*columns).union(term.select(*columns))


def vectors(kept: DataFrame, groups: DataFrame, shape: DataFrame, terms: DataFrame) -> DataFrame:
    """Stored (lang, block, station, stations, source, total, kept, width, vector): a row for every group and block of its language.

    ``vector`` is null where the group has none of the block's terms; they count 0 there and so have a share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for entries in batch.column("entries").to_pylist():
                places, counts = (np.array([e[k] for e in entries], np.int64) for k in ("place", "n"))
                made.append(packed(places, counts))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("lang", "source", "block")), pa.array(made, pa.binary())], names=["lang", "source", "block", "vector"])

    listed = kept.join(terms.select("lang", "term", "block", "place"), ["lang", "term"]).groupBy("lang", "source", "block").agg(F.array_sort(F.collect_list(F.struct("place", "n"))).alias("entries"))
    own = listed.mapInArrow(run, "lang string, source string, block int, vector binary")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    widths = terms.groupBy("lang", "block").agg(F.count("*").cast("int").alias("width"))
    grid = groups.join(shape, "lang").join(totals, ["lang", "source"], "left").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    filled = grid.join(widths, ["lang", "block"], "left").join(own, ["lang", "source", "block"], "left")
    station = F.pmod(F.xxhash64("source"), F.col("stations")).cast("int")
    return materialise(filled.select("lang", "block", station.alias("station"), "stations", "source", F.coalesce("total", F.lit(0)).alias("total"), "kept", F.coalesce("width", F.lit(0)).alias("width"), "vector"), "audit-cells")


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents
), r AS (SELECT row_number() OVER () AS k, * FROM d),
t AS (SELECT k, lang, source, unnest(words) AS term FROM r),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, term, count(*) AS n FROM t GROUP BY 1, 2 HAVING count(DISTINCT k) >= 30),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM v GROUP BY 1),
c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN v ON v.lang = t.lang AND v.term = t.term GROUP BY 1, 2, 3),
s AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY 1, 2),
p AS (
  SELECT s.lang, s.source, v.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 5)::HUGEINT) // (s.total + 5 * l.v) AS p, 1 + (1000000000 * (v.n + 5)::HUGEINT) // (l.total + 5 * l.v) AS q
  FROM s JOIN l ON l.lang = s.lang JOIN v ON v.lang = s.lang LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = v.term
), m AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(m.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN m ON m.lang = a.lang AND m.source = a.source AND m.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q
), o AS (SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM f)
SELECT * FROM o WHERE part = 'pair' OR rank <= 50
"""
