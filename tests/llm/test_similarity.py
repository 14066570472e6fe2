"""Jaccard join, components, signature trees, fingerprints: against brute force on small tables."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cadastre.llm import fingerprints, jaccard, signature_tree
from cadastre.llm.components import components


def sets_of(rows, length):
    out = {}
    for k, text in rows:
        w = (text or "").encode().lower().split()
        out[k] = {tuple(w[i : i + length]) for i in range(len(w) - length + 1)} if len(w) >= length else {tuple(w)} - {()}
    return out


def brute(rows, length, percent):
    sets = sets_of(rows, length)
    lead = {k: k for k in sets}

    def find(a):
        while lead[a] != a:
            a = lead[a]
        return a

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                lead[y] = x
    return {k: (len(sets[k]), find(k)) for k in sets}


def copies(seed, n=150):
    draw = random.Random(seed)
    base = [f"{draw.choice('abcdefgh')}{draw.randint(0, 9)}" for _ in range(60)]
    rows = []
    for k in range(n):
        words = list(base)
        for _ in range(draw.choice([0, 1, 2, 4, 6, 9])):
            words[draw.randrange(60)] = f"z{draw.randint(0, 30)}"
        rows.append((k, " ".join(words)))
    return rows + [(1000, None), (1001, ""), (1002, "one"), (1003, "ONE "), (1004, " \t"), (1005, "lonely words that nobody else has in this order")]


@pytest.mark.parametrize("percent,block", [(85, 16), (85, 1000), (60, 16), (95, 1000)])
def test_components_of_near_copies(spark, percent, block):
    rows = copies(percent)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, label string, n_shingles int").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df, length=4, percent=percent, block=block).collect()}
    assert got == brute(rows, 4, percent)


def test_repeated_and_null_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (3, "q r s t")], "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["component_id"]) for r in jaccard.jaccard_components(df).collect())
    assert got == [(-1, 5), (3, 3), (5, 5), (5, 5)]
    assert jaccard.jaccard_components(df.limit(0)).count() == 0
    kept = jaccard.keep_one(df)
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [3, 5] and kept.columns == df.columns


def test_one_of_each_group_stays_where_ids_repeat(spark):
    group, other = "a b c d e f", "one two three four five six"
    rows = [(5, group, "x"), (5, other, "y"), (2, group, "z"), (7, group, "x"), (7, "seven lonely words of another text", "y"), (9, other, "x"), (9, other, "x"), (4, "", "x"), (4, None, "x"), (None, "words of a row without any id", "x"), (None, group, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    kept = jaccard.keep_one(df)
    want = [(2, group, "z"), (5, other, "y"), (7, "seven lonely words of another text", "y"), (4, "", "x"), (4, None, "x"), (None, "words of a row without any id", "x")]
    assert kept.columns == df.columns and sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, want))


def slotted(n, seed=7):
    """One sentence with two slots of 400 values each: many share a slot's value, none are similar."""
    draw = random.Random(seed)
    return [(k, "the {0} a{0}x of our town was b{1}y by {1} on a day".format(draw.randint(0, 399), draw.randint(0, 399))) for k in range(n)]


def test_templates_are_compared_in_proportion(spark, monkeypatch):
    sent = []
    real = jaccard.linked_groups

    def counting(rows, percent):
        rows = rows.cache()
        sent.append(rows.count())
        return real(rows, percent)

    monkeypatch.setattr(jaccard, "linked_groups", counting)
    totals = []
    for n in (1000, 2000):
        sent.clear()
        df = spark.createDataFrame(slotted(n), "doc_id long, text string").repartition(4)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df, length=4, percent=85, block=32).collect()}
        assert n > 1000 or got == brute(slotted(n), 4, 85)
        totals.append(sum(sent))
    assert totals[1] < 3 * totals[0] and totals[1] < 6 * 2000


def test_hot_lists_of_unlike_sets(spark):
    """All share their rarest shingles but not enough of them: one list beyond a block, by size classes, with a linked few."""
    draw = random.Random(9)
    passages = [" ".join(f"p{k}w{j}" for j in range(8)) for k in range(12)]
    rows = [(k, " ".join(draw.sample(passages, draw.choice([2, 3, 6])))) for k in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df, length=4, percent=85, block=16).collect()}
    assert got == brute(rows, 4, 85)


def test_long_text(spark):
    long = " ".join(map(str, range(60_000)))
    df = spark.createDataFrame([(1, long), (2, long + " tail"), (3, "short one")], "doc_id long, text string")
    assert sorted(tuple(r) for r in jaccard.jaccard_components(df).collect()) == [(1, 59_996, 1), (2, 59_997, 1), (3, 1, 3)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 25), min_size=1, max_size=15, unique=True), max_size=40), st.sampled_from([50, 80, 85, 100]))
def test_tree_finds_every_link(data, percent):
    sets = [np.sort(np.array(d, np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for d in data]
    got = signature_tree.link(sets, list(range(len(sets))), percent)
    lead = list(range(len(sets)))

    def find(a):
        while lead[a] != a:
            a = lead[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            if signature_tree.similar(a, sets[j], percent):
                x, y = sorted((find(i), find(j)))
                lead[y] = x
    assert got == [find(k) for k in range(len(sets))]


def test_contraction_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1001 + k) for k in range(50)] + [(5000, 5000)]
    found = components(spark.createDataFrame(edges, "a long, b long").repartition(5), "test").collect()
    groups = {}
    for r in found:
        groups.setdefault(r["label"], set()).add(r["node"])
    assert sorted(map(len, groups.values())) == [1, 51, 301] and all(label in g for label, g in groups.items())


# Fingerprints


def shingles(text):
    w = [x for x in re.split("[ \t\n\x0b\x0c\r]+", text.lower()) if x]
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def test_edited_text_and_neighbours(spark):
    draw = random.Random(4)
    texts = [" ".join(draw.choice("abcdefghij") + str(draw.randint(0, 30)) for _ in range(draw.choice([0, 1, 3, 5, 40, 200]))) for _ in range(60)]
    texts[3], texts[7] = None, texts[8]
    rows = [(None if k == 0 else 3 * k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fingerprint string").repartition(5)
    got = {r["doc_id"]: r for r in fingerprints.edited_pairs(df).collect()}
    errors = []
    for k, (doc, text) in enumerate(rows):
        text, follow = text or "", rows[(k + 1) % len(rows)][1] or ""
        quarter = len(text) // 4
        edited, r = text[: len(text) - quarter] + follow[:quarter], got[doc]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for value, other in ((r["near_edited"], edited), (r["near_next"], follow)):
            a, b = shingles(text), shingles(other)
            errors.append(value - (len(a & b) / len(a | b) if a | b else 1.0))
    assert got[3 * 7]["fingerprint"] == got[3 * 8]["fingerprint"] and max(map(abs, errors)) < 0.2 and abs(np.mean(errors)) < 0.02
    assert fingerprints.edited_pairs(df.limit(0)).count() == 0


def test_repeated_ids_are_ordered_by_text(spark):
    df = spark.createDataFrame([(1, "b b b b"), (1, "a a a a"), (2, "cccc")], "doc_id long, text string")
    got = {(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in fingerprints.edited_pairs(df).collect()}
    want = [(1, "a a a a", "b b b b"), (1, "b b b b", "cccc"), (2, "cccc", "a a a a")]
    assert got == {(d, len(t), hashlib.sha256((t[: len(t) - len(t) // 4] + n[: len(t) // 4]).encode()).hexdigest()) for d, t, n in want}


@pytest.mark.parametrize("ids", ["null", "same strings"])
def test_many_rows_of_one_id(spark, ids):
    """Half of all rows have one id, or none, or are one row: no range holds many more than others, and each row meets the next one."""
    draw = random.Random(len(ids))
    text = lambda k: f"{draw.choice('abc')} text {k} " * draw.choice([1, 3])
    many = [(None if ids == "null" else 7, "same text for all" if ids == "same strings" else text(k)) for k in range(200)]
    rows = many + [(k + 10, text(k)) for k in range(200)] + [(3, ""), (4, None)]
    kind = "long"
    if ids == "same strings":
        rows, kind = [(None if k is None else f"é{k % 13}" if k == 7 else f"doc-{k}", t) for k, t in rows], "string"
    df = spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(6)
    placed, ranges = fingerprints.with_next(df)
    sizes = [r["count"] for r in placed.groupBy("range").count().collect()]
    assert ranges == 8 and len(sizes) == 8 and max(sizes) < 2.5 * len(rows) / 8 and placed.where("guest").count() == 8
    order = [r for r in fingerprints.placed(df).orderBy("at").collect()]
    want = []
    for k, r in enumerate(order):
        t, n = r["text"], order[(k + 1) % len(order)]["text"]
        want.append((str(r["doc_id"]), len(t), hashlib.sha256((t[: len(t) - len(t) // 4] + n[: len(t) // 4]).encode()).hexdigest()))
    got = [(str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in fingerprints.edited_pairs(df).collect()]
    assert sorted(got) == sorted(want)
    assert [r["doc_id"] for r in order if r["doc_id"] is not None] == sorted([r[0] for r in rows if r[0] is not None], key=lambda x: x.encode() if kind == "string" else x)


def test_bins_are_minima_and_empties_are_filled(spark):
    hashes = [k * 0x9E3779B97F4A7C15 % 2**63 for k in range(1, 60)]
    row = spark.createDataFrame([(hashes,), ([],)], "h array<long>").select(fingerprints.bin_minima(F.col("h")).alias("m"), fingerprints.densified(fingerprints.bin_minima(F.col("h"))).alias("d")).collect()
    want = {}
    for h in hashes:
        want[h % 128] = min(want.get(h % 128, 2**63), (h % 128) << 56 | (h >> 7))
    assert [want.get(k) for k in range(128)] == row[0]["m"]
    order = fingerprints.order_of_bins(128)
    assert row[0]["d"] == [want[k] if k in want else want[next(c for c in order[k] if c in want)] for k in range(128)]
    assert row[1]["d"] is None


def test_native_plan(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert not re.search("Python|Arrow|Pandas", fingerprints.edited_pairs(df)._jdf.queryExecution().executedPlan().toString())
