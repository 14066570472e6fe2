"""Source audit, spelling variants, SimHash near-duplicates: against brute force on small tables."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from cadastre.llm import divergence, simhash, spelling

SF = "/root/testdata/sf0.001"


def oracle(sql):
    return duckdb.sql(sql.replace("FROM documents", f"FROM '{SF}/documents.parquet'"))


def audit_brute(rows, least_docs, smoothing, top):
    groups, words = {}, {}
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        own = [w.decode() for w in re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))]
        groups.setdefault((lang, source), Counter()).update(own)
        words.setdefault(lang, Counter()).update(set(own))
    out = set()
    for lang in words:
        kept = sorted((t for t, n in words[lang].items() if n >= least_docs), key=str.encode)
        own = {s: c for (x, s), c in groups.items() if x == lang}

        def share(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + smoothing) // (total + smoothing * len(kept)) for t in kept}

        whole = share(sum(own.values(), Counter()))
        shares = {s: share(c) for s, c in own.items()}
        for s in own:
            pairs = [(sum(abs(shares[s][t] - shares[o][t]) for t in kept), o) for o in own if o != s]
            terms = [(shares[s][t] - whole[t], t) for t in kept if own[s][t] and shares[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found[:most])}
    return out


AUDITED = [
    ("en", "a", "Ab ab cd ef"), ("en", "b", "ab ab gh"), ("en", None, "cd, cd; gh! É É"), ("en", "c", None), ("en", "d", "123 456"), ("en", "a", "Ab ab cd ef"), (None, None, "x x"), (None, "z", "x"), ("fr", "only", "ab"),
    ("de", "a", ""), ("de", "b", None), ("en", "é", "ÉÉ É 日本 日本"), ("en", "f", "日本 É gh " * 40),
]


@pytest.mark.parametrize("how", [{}, {"block_terms": 1, "station_groups": 2, "held": 1}, {"block_terms": 2, "station_groups": 1, "most_stations": 3, "top": 2}])
def test_audit_of_small_groups(spark, how):
    df = spark.createDataFrame([(*r, 7, "n") for r in AUDITED], "lang string, source string, text string, value int, term string").repartition(3)
    got = {tuple(r) for r in divergence.audit(df, least_docs=1, **how).collect()}
    assert got == audit_brute(AUDITED, 1, 5, how.get("top", 50))
    some = {tuple(r) for r in divergence.audit(df, least_docs=3, **how).collect()}
    assert some == audit_brute(AUDITED, 3, 5, how.get("top", 50))


def test_audit_of_nothing_and_registered(spark):
    df = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.audit(df).collect() == []
    got = sorted(tuple(r) for r in divergence.op11_source_audit(spark, SF).collect())
    assert got == sorted(oracle(divergence.OP11_SQL).fetchall()) and {r[2] for r in got} == {"pair", "term"}


@given(st.lists(st.integers(0, 10**15), min_size=1, max_size=5), st.integers(0, 10**16))
def test_shares_are_exact(counts, more):
    total, kept = sum(counts) + more, len(counts) + 3
    assert divergence.shares(np.array(counts), total, kept).tolist() == [1 + 10**9 * (c + 5) // (total + 5 * kept) for c in counts]


@pytest.mark.parametrize("stations", [1, 2, 5, 8])
def test_every_two_stations_meet_once(stations):
    met = Counter(tuple(sorted((i, (r - i) % stations))) for r in range(stations) for i in range(stations) if (r - i) % stations >= i)
    assert met == Counter(tuple(sorted(p)) for p in [*combinations(range(stations), 2), *((i, i) for i in range(stations))])


@given(st.binary(max_size=200).map(lambda b: b.translate(divergence.LETTERS)), st.integers(1, 20))
def test_pieces_keep_words(raw, size):
    assert [w for p in divergence.pieces(raw, size) for w in p.split()] == raw.split()


def near_words(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def variants_brute(rows, least_length=5, least_count=3, drop_every=97):
    n = Counter()
    for k, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= least_length and c >= least_count}
    near = {w: [v for v in n if near_words(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def written(seed):
    draw = random.Random(seed)
    base = ["colour", "color", "colours", "aabbaab", "éclair", "Éclair", "ÿÿÿÿÿ", "straße", "aaaaaa", "aaaaa", "aaaaaaa", "bcdefgh"]
    rows = []
    for k in range(200):
        words = []
        for _ in range(draw.randint(0, 30)):
            w = draw.choice(base)
            if draw.random() < 0.4:
                at, c = draw.randrange(len(w)), draw.choice("abceé")
                w = draw.choice([w[:at] + w[at + 1 :], w[:at] + c + w[at:], w[:at] + c + w[at + 1 :], w + c])
            words.append(w)
        rows.append((k, draw.choice([" ", ", ", "日", "\n", "7"]).join(words)))
    return [*rows, (None, "colour colour colour"), (None, None), (3, ""), (3, "COLOUR" * 3), (3, "COLOUR" * 3), (9, "wörter " * 5000)]


@pytest.mark.parametrize("how", [{}, {"drop_every": 3}, {"drop_every": 0, "least_length": 1, "least_count": 1}])
def test_variants_of_small_texts(spark, how):
    rows = written(len(how))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(3)
    got = {tuple(r) for r in spelling.variants(df, held=50, **how).collect()}
    assert got == variants_brute(rows, **how) and len(got) > 15


def test_variants_where_the_bitmap_is_full(spark, monkeypatch):
    monkeypatch.setattr(spelling, "MOST_BITS", 8)
    monkeypatch.setattr(spelling, "LEAST_BITS", 8)
    rows = written(5)
    got = {tuple(r) for r in spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == variants_brute(rows)


def test_joins_of_variants_send_nothing_to_the_driver(spark, monkeypatch):
    plans = []

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(spelling, "materialise", lambda df, name, keep=spelling.materialise: keep(planned(df), name))
    assert planned(spelling.variants(spark.createDataFrame(written(2), "doc_id long, text string"))).count()
    # So small a table is broadcast wherever that is left to Spark.
    assert not [p for p in plans if "Broadcast" in p] and sum("SortMergeJoin" in p for p in plans) >= 3


def test_variants_of_nothing_and_registered(spark):
    df = spark.createDataFrame([(1, None), (2, "abc 123")], "doc_id long, text string")
    assert spelling.variants(df).collect() == [] and spelling.variants(df.limit(0)).collect() == []
    got = {tuple(r) for r in spelling.op12_spelling_variants(spark, SF).collect()}
    assert got == set(oracle(spelling.OP12_SQL).fetchall())


@settings(max_examples=60)
@given(st.text("abé", min_size=1, max_size=6))
def test_neighbourhood_is_whole_and_distinct(word):
    alphabet = np.array([ord(c) for c in "abé"], np.uint64)
    made, hashed = [], []
    for edit, at, h, counts in spelling.neighbourhood(spelling.code_points([word]), alphabet):
        for c in np.flatnonzero(counts[0]):
            made.append(spelling.edited(word, edit, at, "abé"[c]))
            hashed.append(int(h[0, c]))
    want = {word[:k] + word[k + 1 :] for k in range(len(word))} | {word[:k] + c + word[j:] for k in range(len(word) + 1) for j in (k, k + 1) if j <= len(word) for c in "abé"} - {word}
    assert sorted(made) == sorted(want)
    assert all(int(spelling.hashes(spelling.code_points([m]))[0]) == h for m, h in zip(made, hashed, strict=True) if m)


def test_long_chains_reach_their_root(spark):
    forms = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(37)], "word string, form string")
    assert {r["root"] for r in spelling.rooted(forms).collect()} == {"w37"}


def print_brute(text, length=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    grams = [b" ".join(words[k : k + length]) for k in range(len(words) - length + 1)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def parts(prints, radius):
    lead = {p: p for p in prints}

    def find(a):
        while lead[a] != a:
            a = lead[a]
        return a

    for a, b in combinations(sorted(lead), 2):
        if (a ^ b).bit_count() <= radius:
            lead[find(a)] = find(b)
    return {p: find(p) for p in lead}


def scattered(seed, n=120):
    draw, prints = random.Random(seed), []
    while len(prints) < n:
        if prints and draw.random() < 0.8:
            p = draw.choice(prints)
            for b in draw.sample(range(64), draw.choice([1, 2, 3, 3, 3, 4, 4])):
                p ^= 1 << b
        else:
            p = draw.getrandbits(64)
        prints.append(p)
    return prints


@pytest.mark.parametrize("radius,buckets,n", [(0, 16, 60), (1, 16, 60), (2, 1, 120), (2, 16, 120), (3, 1, 100), (3, 16, 120), (3, 4096, 30), (4, 16, 30)])
def test_balls_connect_what_is_near(radius, buckets, n):
    balls = simhash.Balls(radius, buckets)
    for seed in range(3):
        prints = sorted(set(scattered(seed, n)))
        dealt = {}
        for bucket, own in balls.destinations(np.array(prints, np.uint64)):
            dealt.setdefault(bucket, []).append(own)
        edges = [(int(a), int(b)) for bucket, own in dealt.items() for a, b in zip(*balls.meetings(bucket, np.concatenate(own)), strict=True)]
        assert all((a ^ b).bit_count() <= radius for a, b in edges)
        lead = {p: p for p in prints}

        def find(a, lead=lead):
            while lead[a] != a:
                a = lead[a]
            return a

        for a, b in edges:
            lead[find(a)] = find(b)
        want = parts(prints, radius)
        assert len({(find(p), want[p]) for p in prints}) == len({find(p) for p in prints}) == len(set(want.values()))


def test_every_flip_of_three_bits_is_met():
    balls, draw = simhash.Balls(3, 64), random.Random(3)
    for bits in list(combinations(range(0, 64, 5), 3)) + [tuple(draw.sample(range(64), 3)) for _ in range(60)]:
        a = draw.getrandbits(64)
        pair = np.array([a, a ^ sum(1 << b for b in bits)], np.uint64)
        assert any(len(own) == 2 and len(balls.meetings(bucket, own)[0]) for bucket, own in balls.destinations(pair))


@given(st.text(st.characters(codec="utf-8"), max_size=60))
def test_prints_of_any_text(text):
    assert simhash.simhash(text.encode()) == print_brute(text)


def test_documents_and_components(spark):
    draw = random.Random(1)
    base = [f"w{draw.randint(0, 400)}" for _ in range(300)]
    rows = []
    for k in range(120):
        words = list(base) if k % 3 else [f"v{draw.randint(0, 99)}" for _ in range(40)]
        for _ in range(draw.choice([0, 1, 2, 3])):
            words[draw.randrange(len(words))] = "zz"
        rows.append((k, " ".join(words)))
    rows += [(1000, None), (1001, ""), (1002, " \t"), (1003, "one TWO"), (1004, "One two"), (None, rows[1][1]), (None, "alone with no id at all"), (1, rows[1][1]), (1005, "long " * 200_000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, component_id int, fingerprint string").repartition(4)
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["fingerprint"], r["component_id"] if r["component_id"] is not None else -1) for r in simhash.near_duplicates(df, bucket_words=5000).collect())
    prints = [print_brute(t) for _, t in rows]
    part = parts(prints, 3)
    least = {}
    for (k, _), p in zip(rows, prints, strict=True):
        if k is not None:
            least[part[p]] = min(k, least.get(part[p], k))
    assert got == sorted((-1 if k is None else k, f"{p:016x}", least.get(part[p], -1)) for (k, _), p in zip(rows, prints, strict=True))


def test_no_documents_and_registered(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id int, text string")).collect() == []
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = [print_brute(r["text"]) for r in docs]
    part, least = parts(prints, 3), {}
    for r, p in zip(docs, prints, strict=True):
        least[part[p]] = min(r["doc_id"], least.get(part[p], r["doc_id"]))
    got = {tuple(r) for r in simhash.op13_simhash_dedup(spark, SF).collect()}
    assert got == {(r["doc_id"], f"{p:016x}", least[part[p]]) for r, p in zip(docs, prints, strict=True)}
