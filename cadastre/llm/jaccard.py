"""N-gram Jaccard join: documents linked by similar shingle sets, and their components.

1. Shingle sets are hashed, and every shingle's document frequency is counted exactly.
2. A set's prefix is its rarest shingles, one more than a similar set may lack. Similar
   sets share one in their prefixes; equal sets are one from here on. All sets with one
   shingle in their prefixes are that shingle's list, and all links lie within lists.
3. Each set is first joined in one list alone, the largest it is in, by signature trees. A list
   beyond ``block`` sets is dealt into blocks; the components of each block send one set
   each to the next level, and so on. For groups of copies this does nearly all of it.
4. Lists whose sets are not one component by then stay open, of lists with the same sets one. Components
   that open lists connect are a region; one set of each component meets those of its region.
5. What is open even then is joined whole, each region list by list or all at once, whichever takes
   fewer rows: in one tree, or beyond ``block`` sets by size classes (sets link within one class or with
   the next), block against block, the smaller components against all of the class. So no link is
   lost, copies are never paired off, and texts that only share a template are compared list by list.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import Block, Counted, exchange, in_blocks, mixed, read_answers, release_memory
from .common import drop_scratch, long_id, materialise, table, text_bytes
from .components import components
from .signature_tree import link, needed

BLOCK = 128


def shingles(block: Block, length: int) -> list[np.ndarray]:
    """By row, the sorted distinct keys of the word ``length``-grams, or of all its words if fewer."""
    keys, out = block.keys, []
    grams = mixed(*[keys[k : len(keys) - length + 1 + k] for k in range(length)]) if len(keys) >= length else keys[:0]
    for a, b in zip(block.starts.tolist(), block.ends.tolist(), strict=True):
        if b - a >= length:
            out.append(np.unique(grams[a : b - length + 1]))
        else:
            out.append(mixed(*[keys[k : k + 1] for k in range(a, b)]) if b > a else keys[:0])
    return out


def asker(length: int):
    def ask(block: Block, _: list[np.ndarray] | None) -> list[Counted]:
        return [np.unique(np.concatenate(shingles(block, length)), return_counts=True)]

    return ask


SETS = "uid long, doc_id long, n long, print string, keys array<long>, shingles binary"


def shingle_sets(docs: DataFrame, length: int, percent: int, name: str) -> DataFrame:
    """Stored rows of ``SETS``: for sets that can have a link, their shared prefix shingles and all shingles."""
    given = docs.select(long_id(), text_bytes().alias("text"))
    found, _ = exchange(in_blocks(given, f"{name}-blocks"), asker(length), 1, f"{name}-answers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.binary()]
        names = [f.split()[0] for f in SETS.split(", ")]
        part, serial = TaskContext.get().partitionId(), 0
        for batch in batches:
            for k in range(batch.num_rows):
                block = Block.unpack(batch.column(0)[k].as_py())
                sets = shingles(block, length)
                _, number = np.unique(np.concatenate(sets), return_inverse=True)
                (frequency,) = read_answers(batch.column(1)[k].as_py())
                frequency, low, made = frequency[number], 0, []
                for doc, own in zip(block.rows["doc_id"].to_pylist(), sets, strict=True):
                    n, kept, digest, raw = len(own), None, None, None
                    df, low = frequency[low : low + n], low + n
                    length_of_prefix = n - needed(n, percent) + 1
                    # Shingles of no other document come first: often they are the whole prefix.
                    if n and int((df == 1).sum()) < length_of_prefix:
                        prefix = np.lexsort((own, df))[:length_of_prefix]
                        shared = own[prefix[df[prefix] > 1]]
                        raw = own.tobytes()
                        kept, digest = shared.view(np.int64).tolist(), xxhash.xxh3_128_hexdigest(raw)
                    made.append(((part << 36) + serial, doc, n, digest, kept, raw))
                    serial += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), kinds, strict=True)], names=names)
                release_memory()

    sets = materialise(found.select("payload", "answers").mapInArrow(run, SETS), f"{name}-sets")
    drop_scratch(found)
    return sets


GROUP = ["cell", "size_class", "x", "y"]


def linked_groups(rows: DataFrame, percent: int) -> DataFrame:
    """(uid, was, label) of ``rows`` (columns of GROUP; uid, label, shingles), each group joined by one tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, uids, labels, sets = None, [], [], []

        def close() -> pa.RecordBatch:
            found = link(sets, labels, percent)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (uids, labels, found)], names=["uid", "was", "label"])

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for *own, uid, label, raw in zip(*columns, strict=True):
                if own != key:
                    if uids:
                        yield close()
                    key, uids, labels, sets = own, [], [], []
                uids.append(uid)
                labels.append(label)
                sets.append(np.frombuffer(raw, np.uint64))
        if uids:
            yield close()

    dealt = rows.select(*GROUP, "uid", "label", "shingles").repartition(*GROUP).sortWithinPartitions(*GROUP, "uid")
    return dealt.mapInArrow(run, "uid long, was long, label long")


def dealt(size: Column, block: int, seed: int) -> Column:
    """A block of the row's cell for it: by its hash, so many that a block has ``block`` rows or a little fewer."""
    return F.when(size <= block, F.lit(0)).otherwise(F.pmod(F.xxhash64("uid", F.lit(seed)), F.ceil(size / (0.75 * block))).cast("int"))


def in_levels(members: DataFrame, percent: int, block: int, name: str) -> DataFrame:
    """Stored (uid, label) of ``members`` (cell, uid, shingles), each uid in one cell: sets of one label are linked.

    Level by level, one set of each component of a block meets those of others. Ends once every
    cell fits one block, or a level merges few: those links are left to the lists.
    """
    top, level, labels, seed = members, None, None, 0
    while True:
        sizes = materialise(top.groupBy("cell").agg(F.count("*").alias("size")), f"{name}-sizes")
        sized = top.join(sizes, "cell")
        begun = sized.select("cell", F.lit(0).alias("size_class"), dealt(F.col("size"), block, seed).alias("x"), F.lit(0).alias("y"), "uid", F.col("uid").alias("label"), "shingles")
        level = materialise(linked_groups(begun, percent).select("uid", "label"), f"{name}-level")
        if labels is None:
            labels = level
        else:
            step = level.select(F.col("uid").alias("label"), F.col("label").alias("to"))
            labels = materialise(labels.join(step, "label", "left").select("uid", F.coalesce("to", "label").alias("label")), f"{name}-labels")
        heads = sized.where(F.col("size") > block).select("cell", "uid", "shingles").join(level.where("uid = label").select("uid"), "uid", "left_semi")
        top = materialise(heads, f"{name}-heads")
        before, left = sizes.where(F.col("size") > block).agg(F.sum("size")).first()[0] or 0, top.count()
        if not left or left > 0.8 * before:
            return labels
        seed += 1


def open_lists(placed: DataFrame, name: str) -> DataFrame:
    """Stored (key, uid, label) of the lists of ``placed`` (key, uid, label) whose sets are not one component; of lists with the same sets one."""
    same = [F.bit_xor(F.xxhash64("uid", F.lit(seed))).alias(f"same_{seed}") for seed in (1, 2)]
    lists = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"), *same).where("low < high")
    chosen = materialise(lists.groupBy("size", "same_1", "same_2").agg(F.min("key").alias("key")).select("key"), f"{name}-keys")
    found = materialise(placed.join(chosen, "key").select("key", "uid", "label"), f"{name}-open")
    drop_scratch(chosen)
    return found


def regions_of(opened: DataFrame, name: str) -> DataFrame:
    """(label, region): labels that open lists connect, directly or through others."""
    first = opened.groupBy("key").agg(F.min("label").alias("b"))
    edges = opened.join(first, "key").where("label <> b").select(F.col("label").alias("a"), "b").distinct()
    return components(edges, f"{name}-regions").select(F.col("node").alias("label"), F.col("label").alias("region"))


def classed(rows: DataFrame, percent: int, block: int, name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` (region, cell, uid, label, n) by size class, and of each class its main label, sizes and cost, stored.

    Cells of one block are one class. ``cost`` is how many rows it takes to let all its sets of different labels meet.
    """
    sizes = rows.groupBy("cell").agg(F.count("*").alias("size"))
    # A class is a little wider than the ratio of sizes that may link, so that rounding parts none of them.
    ratio = math.log(100 / percent * 1.001) if percent < 100 else 1e-3
    own = F.floor(F.log(F.col("n").cast("double")) / ratio).cast("int")
    classes = F.when(F.col("size") <= block, F.array(F.lit(0))).otherwise(F.array(own, own - 1))
    spread = rows.join(sizes, "cell").withColumn("size_class", F.explode(classes)).drop("size")
    parts = spread.groupBy("region", "cell", "size_class", "label").agg(F.count("*").alias("m"))
    main = parts.groupBy("region", "cell", "size_class").agg(F.max(F.struct("m", "label")).alias("main"), F.sum("m").alias("total"), F.count("*").alias("labels"))
    kept = main.where("labels > 1").select("region", "cell", "size_class", F.col("main.label").alias("main"), F.col("main.m").alias("most"), (F.col("total") - F.col("main.m")).alias("rest"), "total")
    half = max(1, block // 2)
    minors, majors = F.ceil(F.col("rest") / half).cast("int"), F.ceil(F.col("most") / half).cast("int")
    cost = F.when(F.col("total") <= block, F.col("total")).otherwise(F.col("rest") * (minors + majors) + F.col("most") * minors)
    return spread, materialise(kept.withColumns({"minors": minors, "majors": majors, "cost": cost}), f"{name}-classes")


def meeting(spread: DataFrame, sized: DataFrame, block: int) -> DataFrame:
    """(columns of GROUP, uid, label): every two sets of a class of different labels meet in one group at least."""
    placed = spread.join(sized.drop("region"), ["cell", "size_class"]).withColumn("minor", F.col("label") != F.col("main"))
    minors, majors = F.col("minors"), F.col("majors")
    at = F.pmod(F.xxhash64("uid", F.lit(-1)), F.when(F.col("minor"), minors).otherwise(majors)).cast("int")
    every = F.sequence(F.lit(0), minors - 1)
    # Group (x, y): minor block x with minor block y >= x, or with main block y - minors.
    pair = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    of_minor = F.concat(F.transform(every, lambda k: pair(F.least(k, at), F.greatest(k, at))), F.transform(F.sequence(F.lit(0), majors - 1), lambda k: pair(at, minors + k)))
    of_main = F.transform(every, lambda k: pair(k, minors + at))
    groups = F.when(F.col("total") <= block, F.array(pair(F.lit(0), F.lit(0)))).when(F.col("minor"), of_minor).otherwise(of_main)
    return placed.withColumn("group", F.explode(groups)).select("cell", "size_class", "group.x", "group.y", "uid", "label")


def last_links(opened: DataFrame, regions: DataFrame, sets: DataFrame, percent: int, block: int, name: str) -> DataFrame:
    """Stored edges (a, b) between labels of ``opened`` lists: each region list by list or as a whole, whichever takes fewer rows."""
    rows = materialise(opened.join(regions, "label").join(sets.select("uid", "n"), "uid"), f"{name}-rows")
    by_list, lists = classed(rows.withColumnRenamed("key", "cell"), percent, block, f"{name}-lists")
    by_region, wholes = classed(rows.select("region", F.col("region").alias("cell"), "uid", "label", "n").distinct(), percent, block, f"{name}-wholes")
    costs = lists.groupBy("region").agg(F.sum("cost").alias("lists")).join(wholes.groupBy("region").agg(F.sum("cost").alias("whole")), "region", "left")
    listed = materialise(costs.where("whole IS NOT NULL AND lists < whole").select("region"), f"{name}-listed")
    rest = wholes.join(listed, "region", "left_anti")
    met = meeting(by_list, lists.join(listed, "region", "left_semi"), block).union(meeting(by_region, rest, block))
    found = linked_groups(met.join(sets.select("uid", "shingles"), "uid"), percent)
    edges = materialise(found.where("was <> label").select(F.col("was").alias("a"), F.col("label").alias("b")).distinct(), f"{name}-edges")
    drop_scratch(rows, lists, wholes, listed)
    return edges


def relabelled(labels: DataFrame, step: DataFrame, name: str) -> DataFrame:
    """Stored ``labels`` (uid, label) after ``step`` (label, to)."""
    return materialise(labels.join(step, "label", "left").select("uid", F.coalesce("to", "label").alias("label")), f"{name}-labels")


def link_sets(sets: DataFrame, percent: int, block: int, name: str) -> DataFrame:
    """Stored (uid, label) of ``sets`` (uid, n, keys, shingles) that are in a list: one label for each component."""
    posted = materialise(sets.select("uid", F.explode("keys").alias("key")), f"{name}-postings")
    sizes = materialise(posted.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), f"{name}-keys")
    postings = materialise(posted.join(sizes, "key"), f"{name}-listed")
    homes = postings.groupBy("uid").agg(F.max(F.struct("size", "key")).alias("home")).select("uid", F.col("home.key").alias("cell"))
    members = materialise(sets.select("uid", "shingles").join(homes, "uid"), f"{name}-members")
    labels = in_levels(members, percent, block, name)
    opened = open_lists(postings.select("uid", "key").join(labels, "uid"), f"{name}-first")
    regions = materialise(regions_of(opened, name), f"{name}-regions")
    drop_scratch(posted, sizes, postings, members)
    # One set of each label meets those of its region, as in one more level.
    heads = opened.groupBy("label").agg(F.min("uid").alias("uid")).join(regions, "label")
    heads = materialise(heads.join(sets.select("uid", "shingles"), "uid").select("label", F.col("region").alias("cell"), "uid", "shingles"), f"{name}-heads")
    met = in_levels(heads.select("cell", "uid", "shingles"), percent, block, f"{name}-met")
    own = heads.select("uid", F.col("label").alias("was"))
    step = own.join(met, "uid").join(own.select(F.col("uid").alias("label"), F.col("was").alias("to")), "label").select(F.col("was").alias("label"), "to")
    step = materialise(step.where("label <> to"), f"{name}-step")
    nearer = relabelled(labels, step, name)
    still = open_lists(opened.join(step, "label", "left").select("key", "uid", F.coalesce("to", "label").alias("label")), f"{name}-second")
    kept = regions.join(step, "label", "left").select(F.coalesce("to", "label").alias("label"), "region").distinct()
    edges = last_links(still, kept, sets, percent, block, name)
    merged = components(edges, f"{name}-merged").select(F.col("node").alias("label"), F.col("label").alias("to"))
    done = relabelled(nearer, merged, name)
    drop_scratch(labels, opened, regions, heads, met, step, nearer, still, edges)
    return done


def jaccard_components(docs: DataFrame, *, length: int = 5, percent: int = 80, block: int = BLOCK, name: str = "jaccard") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id of any integer type, text).

    Two rows link when 100 * intersection >= ``percent`` * union of their shingle sets.
    ``component_id`` is the smallest doc_id reachable. Rows without words, null texts too, have
    empty sets and link with nothing. Repeated rows are rows of one component; a null doc_id
    is never the smallest unless its component has no other. Other columns are ignored.
    """
    sets = shingle_sets(docs, length, percent, name)
    active = sets.where("print IS NOT NULL")
    nodes = materialise(active.groupBy("print").agg(F.min("uid").alias("uid")), f"{name}-nodes")
    # One of all equal sets.
    single = materialise(active.select("uid", "n", "keys", "shingles").join(nodes.select("uid"), "uid", "left_semi"), f"{name}-single")
    labels = link_sets(single, percent, block, name)
    node_of = active.select("doc_id", "n", "print").join(nodes, "print").select("doc_id", "n", "uid")
    placed = materialise(node_of.join(labels, "uid", "left").select("doc_id", "n", F.coalesce("label", "uid").alias("label")), f"{name}-placed")
    leaders = materialise(placed.groupBy("label").agg(F.min("doc_id").alias("component_id")), f"{name}-leaders")
    rest = materialise(sets.where("print IS NULL").select("doc_id", "n"), f"{name}-rest")
    drop_scratch(sets, nodes, single, labels)
    together = placed.join(leaders, "label").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return together.union(rest.select("doc_id", "n", F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with one row of each component: of the smallest doc_id (nulls last), and of rows of one id the first.

    Rows are told apart by numbers of their own, so ids may repeat or be null: a row goes only if
    its own text is linked with another that stays. Rows without words stay.
    """
    rows = materialise(docs.withColumn("__row", F.monotonically_increasing_id()), "jaccard-rows")
    found = jaccard_components(rows.select(F.col("__row").alias("doc_id"), "text"), **how).where("n_shingles > 0")
    grouped = found.select(F.col("doc_id").alias("__row"), "component_id")
    # Components of one row are most of all; only rows of larger ones are looked at.
    larger = materialise(grouped.join(grouped.where("__row <> component_id").select("component_id").distinct(), "component_id", "left_semi"), "jaccard-larger")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")
    first = larger.join(rows.select("__row", "doc_id"), "__row").groupBy("component_id").agg(F.min(order).alias("first")).select("first.__row")
    dropped = materialise(larger.join(first, "__row", "left_anti").select("__row"), "jaccard-dropped")
    return rows.join(dropped, "__row", "left_anti").select(*docs.columns)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), length=4, percent=85)


OP4_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), places AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS i FROM d WHERE len(words) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS g FROM places),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) m ON m.a = d.doc_id
"""
