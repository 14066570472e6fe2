"""Scoring, toxicity, secrets, decontamination, sharding, pipeline."""

from __future__ import annotations

import base64
import collections
import hashlib
import math
import random
import uuid
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cadastre.llm import blocks, decontamination, queries, scoring, secrets, sharding, toxicity
from cadastre.llm.common import id_crc, key_bounds, range_of

SF = "/root/testdata/sf0.001"

# Scoring


def brute_scores(rows, strength):
    """The automaton as a dictionary of states with arcs and failures, walked token by token."""
    counts, continued = collections.Counter(), collections.Counter()
    texts = [((t or "").encode().lower().split() + [b"\n"]) for _, t, _ in rows]
    for (_, _, learn), text in zip(rows, texts, strict=True):
        if learn:
            past = [b"^", *text]
            for k, w in enumerate(text):
                for history in ((), tuple(past[k : k + 1]), tuple(past[k - 1 : k + 1]) if k else None):
                    if history is not None:
                        counts[history, w] += 1
                        continued[history] += 1
    n, known = continued[()], len({w for h, w in counts if h == ()})

    def weight(history, w):
        """Of the arc or of the failure and all that follows."""
        if not history:
            return (counts[(), w] + 0.5) / (n + 0.5 * (known + 1))
        if not continued[history]:
            return weight(history[1:], w)
        return ((counts[history, w] + strength * weight(history[1:], w)) if counts[history, w] else strength * weight(history[1:], w)) / (continued[history] + strength)

    out = []
    for (doc, _, _), text in zip(rows, texts, strict=True):
        state, past, score, base, failures = (b"^",) if continued[b"^",] else (), (b"^",), 0.0, 0.0, 0
        for w in text:
            base += math.log10(weight((), w))
            while state and not counts[state, w]:
                score += math.log10(strength / (continued[state] + strength))
                failures += 1
                state = state[1:]
                while state and not continued[state]:
                    state = state[1:]
            score += math.log10(weight(state, w))
            past = state = (*past, w)[-2:]
            while state and not continued[state]:
                state = state[1:]
        out.append((doc, len(text), sum(counts[(), w] > 0 for w in text), n, base, score, failures))
    return out


def test_scores(spark, monkeypatch):
    draw = random.Random(1)
    rows = [(k, " ".join(draw.choice(["The", "cat", "sat", "on", "mat", f"w{draw.randint(0, 50)}"]) for _ in range(draw.choice([0, 1, 5, 40]))), k % 3 != 0) for k in range(80)]
    rows += [(100, None, True), (100, "the cat", False), (101, "the cat sat " * 4000, True)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id int, text string, l boolean, score double").repartition(3)
    for size in (500, 1 << 20):
        monkeypatch.setattr(blocks, "BLOCK_BYTES", size)
        got = sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6), r["n_failures"]) for r in scoring.score(df, F.col("l")).collect())
        want = sorted((*w[:4], round(w[4], 6), round(w[5], 6), w[6]) for w in brute_scores(rows, 8.0))
        assert got == want
    assert scoring.score(df.limit(0), F.col("l")).count() == 0
    assert {r["n_known"] for r in scoring.score(df, F.lit(None).cast("boolean")).collect()} == {0}


def test_base_scores_exchange_words_alone(spark, monkeypatch):
    sf, columns = "/root/testdata/sf0.001", ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens"]
    rounded = [*columns, F.round("base_score", 4).alias("base_score")]
    whole = scoring.op2_lm_scoring(spark, sf).select(*rounded).collect()
    asked, exchange = [], scoring.exchange

    def watched(blocks_, ask, families, name, **how):
        asked.append((name, families))
        return exchange(blocks_, ask, families, name, **how)

    monkeypatch.setattr(scoring, "exchange", watched)
    assert sorted(queries.llm_base_scores(spark, sf).collect()) == sorted(whole) and asked == [("lm-words", 1)]
    df = spark.createDataFrame([(1, "a b a", True), (1, None, True), (None, "b c", False)], "doc_id long, text string, l boolean")
    bare = scoring.score(df, F.col("l"), history=0).collect()
    assert len(bare) == 3 and all(r["score"] == r["base_score"] and r["n_failures"] == 0 for r in bare)
    assert scoring.score(df.limit(0), F.col("l"), history=0).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 3)), max_size=30), max_size=8), st.sampled_from([1, 7, 1000]))
def test_buckets_beyond_memory(tmp_path_factory, given_, run_keys):
    blocks.RUN_KEYS, kept = run_keys, blocks.RUN_KEYS
    try:
        bucket, want = blocks.Bucket(tmp_path_factory.mktemp("b")), collections.Counter()
        for part in given_:
            own = collections.Counter()
            for k, n in part:
                own[k * 2**57] += n
            want.update(own)
            keys = sorted(own)
            bucket.add(np.array(keys, np.uint64), np.array([own[k] for k in keys], np.int64))
        keys, counts = bucket.total()
        assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == dict(want) and keys.tolist() == sorted(want)
    finally:
        blocks.RUN_KEYS = kept


def test_blocks_hold_texts_of_any_length():
    import pyarrow as pa

    texts = [b"", b" A  b\tc ", ("w\u00e9 " * 900_000).encode(), b"x" * 3_000_000, b"one " + b"y" * 2_000_000 + b" two"]
    block = blocks.Block.unpack(blocks.Block.of(pa.table({"k": list(range(5)), "text": pa.array(texts, pa.binary())})).pack())
    for text, a, b in zip(texts, block.starts, block.ends, strict=True):
        assert block.keys[a:b].tolist() == blocks.WordHashes()(text.lower().split()).tolist()
    assert block.rows["k"].to_pylist() == list(range(5))


@pytest.mark.parametrize("most", [8, 1000])
def test_blobs_grow_with_blocks(spark, monkeypatch, most):
    """Past ``MOST_BUCKETS`` a block asks as many buckets as before: blobs of two real sizes, counted as they are shuffled."""
    monkeypatch.setattr(blocks, "MOST_BUCKETS", most)
    monkeypatch.setattr(blocks, "BUCKET_BYTES", 2000)
    ask = lambda block, _: [np.unique(block.keys, return_counts=True)]
    rows = []
    for n in (400, 1600):
        docs = spark.range(n).selectExpr("id AS doc_id", "CAST(repeat(concat('word', id % 50, ' '), 20) AS BINARY) AS text").repartition(4)
        given = blocks.in_blocks(docs, f"grow-{n}")
        size, count = given.agg(F.sum("size").alias("s"), F.count("*").alias("n")).first()
        found, (told,) = blocks.exchange(given, ask, 1, f"grow-answers-{n}")
        answers = found.select(F.explode(F.flatten("answers")).alias("a")).count()
        assert told.keys == 50 and told.total == 20 * n and answers == count * min(most, max(4, -(-size // 2000)))
        rows.append(answers // count)
    # Beyond the bound as many a block; below it in proportion to the input.
    assert rows[1] == rows[0] if most == 8 else rows[1] > 3 * rows[0]


def test_weights_of_a_state_sum_to_one():
    rows = [(1, "a b a c", True), (2, "a a b", True)]
    c = collections.Counter(w for _, t, _ in rows for w in [*t.split(), "end"])
    after_a, mass, strength = {"b": 2, "c": 1, "a": 1}, sum(c.values()) + 0.5 * (len(c) + 1), 8.0
    root = {w: (n + 0.5) / mass for w, n in c.items()} | {"unknown": 0.5 / mass}
    state = {w: (after_a.get(w, 0) + strength * p) / (sum(after_a.values()) + strength) for w, p in root.items()}
    assert math.isclose(sum(root.values()), 1) and math.isclose(sum(state.values()), 1)


# Toxicity


def test_held_out_accuracy_and_no_leak(spark):
    draw = random.Random(2)
    rows, labels = [], []
    for k in range(600):
        toxic = k % 7 == 0
        words = [f"{draw.choice('bcdfg')}{draw.choice('aeiou')}{draw.randint(0, 400)}x" for _ in range(40)]
        if toxic:
            words += [draw.choice(["idiot", "zorkelina", "zorkelemu", "brimbel"]) for _ in range(3)]
        draw.shuffle(words)
        rows.append((k, " ".join(words), "x"))
        labels.append((k, int(toxic)))
    rows += [(900, None, "x"), (901, "", "x"), (None, "idiot zorkelina", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame([*labels, (3, None), (None, 1), (0, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, marks, id_crc("doc_id", 5) != 0)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    wrong = [k for k, y in labels if zlib.crc32(str(k).encode()) % 5 == 0 and got[k]["predicted"] != y]
    assert len(wrong) <= 2 and got[900]["predicted"] == got[901]["predicted"] == 0 and got[None]["predicted"] == 1
    assert toxicity.score(docs.limit(0), model).count() == 0
    nothing = toxicity.train(docs, marks.limit(0), F.lit(True))
    assert nothing.score(b"you idiot") > 0.5 > nothing.score(b"fine")


def test_patterns_vote_where_no_term_is_known():
    texts = [b"YOU ARE SUCH A ZQXBLIK", b"go away zqxblik!!!! ##$%", b"what a zqx*lik you are", b"you zqxbliiiiik", b"see www.example.org for a plain text, fine."]
    rows = [(0, b" ".join(toxicity.terms_of(t)), toxicity.shape_of(t)) for t in texts]
    votes, voters = toxicity.votes_of(rows, {})
    said = [{v for v, n in zip(voters, row, strict=True) if n > 0} for row in votes]
    assert voters[-1] == "label" and said == [{"capitals"}, {"marks"}, {"marks", "stretched or masked words"}, {"stretched or masked words"}, set()]


def test_label_model_learns_who_is_right():
    draw = np.random.default_rng(3)
    y = draw.random(3000) < 0.2
    vote = lambda right: np.where(draw.random(3000) < right, np.where(y, 1, -1), np.where(y, -1, 1))
    good, poor = vote(0.95), vote(0.6)
    votes = np.stack([good, poor, poor, poor, vote(0.9), vote(0.98)], 1).astype(np.int8)
    q, parents = toxicity.label_model(votes, 0.2)
    assert ((q > 0.5) == y).mean() > 0.95
    # Three voters that always agree hang on one another, so that together they say no more than one.
    assert sum(p in (1, 2, 3) for v, p in enumerate(parents) if v in (1, 2, 3)) == 2 and parents[-1] == -1
    alone, _ = toxicity.label_model(votes[:, [0, 1, 4, 5]], 0.2)
    assert np.abs(alone - q).mean() < 0.02


def test_training_and_scoring_see_the_same_features():
    odds = {b"brimbel": 3.0, b"brim*": 1.5, b"brimb*": 3.5, b"idiot": 2.0}
    text = b"Brimbels and brimbel, brimmed idiot idiot"
    words = {t for t in toxicity.terms_of(text) if not t.endswith(b"*")}
    assert toxicity.terms_hit(words, odds) == ({b"brimb*", b"brim*", b"idiot"}, 2)
    model = toxicity.Model(odds, dict.fromkeys(odds, 1.0), hits=0.5, bias=-2.0)
    assert math.isclose(model.score(text), 1 / (1 + math.exp(-(-2.0 + 3 + 2 * 0.5))))


def test_repeated_ids_clashing_columns_and_long_texts(spark):
    long = "fine words here " * 60_000
    rows = [(k, f"idiot zorkel moron scum {'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}" if k % 3 == 0 else f"quiet day number {k}", 1.5, "x") for k in range(60)] + [(5, long, 2.5, "y")] * 3 + [(0, "idiot zorkel moron scum", 0.0, "z")] * 4 + [(None, None, 0.0, "n")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, score double, predicted string").repartition(4)
    marks = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(60)], "doc_id int, toxic int")
    models = [toxicity.train(d, marks, F.lit(True)) for d in (docs, docs.repartition(2))]
    assert models[0] == models[1]
    kept = toxicity.reject(docs, models[0])
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    assert sorted(r["score"] for r in kept.collect()) == sorted([1.5] * 40 + [2.5] * 3 + [0.0])
    assert toxicity.score(docs, models[0]).columns == ["doc_id", "text", "score", "predicted"]


# Secrets

PARTS = st.sampled_from(["token", "TOKEN", "ſecret", "secret", "api_key", "apikey", "password", ": ", "=", " = ", '"', "'", "abc", "abcdef", "ab12", "AKIA", "A" * 16, "f" * 24, "0" * 23, "é", "日", " ", "\n", "K"])


@settings(max_examples=200, deadline=None)
@given(st.lists(PARTS, max_size=25))
def test_base_spans(parts):
    text = "".join(parts)
    spans = secrets.base_spans(text)
    digest = hashlib.sha256(secrets.span_text(spans).encode()).hexdigest()
    assert (*(sum(k == n for _, k, _ in spans) for n in range(3)), digest) == secrets.op6_brute_force(text)


def test_learnt_formats():
    formats = secrets.default_formats()
    unseen = secrets.labelled_formats(40, seed=123)
    assert sum(formats.gain(v)[0] >= secrets.BITS for _, v in unseen) / len(unseen) > 0.9
    plain = ["Andananblestheenthe2024", "inter-national-organisation-2019", "2024-01-02T03-04-05-and-more", "the_quick_brown_fox_2_jumps", "chapter-12-section-4-paragraph-9", "0b1c2d3e-aaaa-4bbb-8ccc-0123456789ab"]
    assert all(formats.gain(p)[0] < secrets.BITS for p in plain)
    # States tell places apart: a format of fixed length has one for each, but for the open ones it may join.
    sizes = {n: len(a.states) for n, a in formats.automata.items()}
    assert all(n > 20 for f, n in sizes.items() if f != "base64-block") and sizes["base64-block"] < 300, sizes


def test_corpus_teaches_formats(spark):
    """A format that only the corpus shows, by its assignments; held-out values of it, alone in a text, are found."""
    draw = random.Random(6)
    key = lambda: "zq-" + "".join(draw.choice("ABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(28))
    words = ["ordinary-path/to/some-file-2020", "another_long_identifier_17", "report-of-the-year-1999-final"]
    rows = [(k, f"token = '{key()}' and then {draw.choice(words)} there") for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labelled, ordinary = secrets.learn(docs)
    assert {n for n, _ in labelled} == {"corpus-assign"} and len(labelled) == 120 and set(ordinary) == {"ordinary-path/to/some-file-2020", "another_long_identifier_17", "report-of-the-year-1999-final"}
    assert secrets.learn(docs.repartition(1)) == (labelled, ordinary)
    formats = secrets.learnt_formats(docs)
    unseen = [key() for _ in range(50)]
    assert sum(formats.gain(v) >= (secrets.BITS, "corpus-assign") for v in unseen) > 45
    assert all(formats.gain(w)[0] < secrets.BITS for w in words)


def corpus_formats(spark):
    """Formats as the query learns them, from a table that has hexadecimal values."""
    return secrets.learnt_formats(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text"))


def found_share(formats, values):
    return sum(formats.gain(v)[0] >= secrets.BITS for v in values) / len(values)


def test_identifiers_and_encoded_text_are_ordinary(spark):
    draw, formats = random.Random(4), corpus_formats(spark)
    assert "corpus-hex" in formats.automata
    words = "the of and to in is you that it he was for on are as with his they at be this have from or one had by word but not what all were we when your can said there use an each which".split()
    sentences = [" ".join(draw.choice(words) for _ in range(draw.randint(5, 25))).capitalize() + draw.choice(".!?") for _ in range(1000)]
    uuids = [str(uuid.UUID(int=draw.getrandbits(128))) for _ in range(1000)]
    assert found_share(formats, uuids) < 0.01 and found_share(formats, [u.upper() for u in uuids]) < 0.01
    for encode in (base64.b64encode, base64.urlsafe_b64encode, lambda b: base64.b64encode(b).rstrip(b"=")):
        assert found_share(formats, [encode(x.encode()).decode() for x in sentences]) < 0.01
    assert found_share(formats, [base64.b64encode(f'{{"user": "é{k}", "ok": true}}'.encode()).decode() for k in range(300)]) < 0.01
    names = [("".join(w.capitalize() for w in some), "_".join(some), "/".join(some) + "-17") for some in ([draw.choice(words) for _ in range(9)] for _ in range(300))]
    assert all(found_share(formats, kind) < 0.01 for kind in zip(*names, strict=True))


def test_credentials_held_out_are_found(spark):
    draw, formats = random.Random(5), corpus_formats(spark)
    assert found_share(formats, [v for _, v in secrets.labelled_formats(100, seed=77)]) > 0.95
    digits = lambda n, of: "".join(draw.choice(of) for _ in range(n))
    # Of the lengths that the corpus shows; 40 random letters of both cases are of one class and found mostly.
    assert found_share(formats, [digits(40, "0123456789abcdef") for _ in range(300)]) > 0.95
    assert found_share(formats, [digits(60, secrets.ALPHABET[:52]) for _ in range(300)]) > 0.8
    half = secrets.labelled_formats(120, seed=9)
    taught = secrets.Formats([*half[::2], ("few", "k9-alpha-7Q2-00001111"), ("few", "k9-alpha-7Q2-00002222")])
    assert found_share(taught, [v for _, v in half[1::2]]) > 0.95
    # Two values teach a format too: what shares their places is found, what does not is not.
    assert taught.gain("k9-alpha-7Q2-00001122")[1] == "few" and taught.gain("k9-alpha-7Q2-00001122")[0] >= secrets.BITS


RUNS = st.sampled_from(["a1B2" * 6, "zq" * 12, "f" * 25, "token=", "'", " ", "AKIA" + "Q7" * 9, "x", "ghp_" + "Ab3" * 12, "é", "\n", "/+", "=" * 3, "9" * 22])


@settings(max_examples=150, deadline=None)
@given(st.lists(RUNS, max_size=14))
def test_candidates_and_spans_by_brute_force(parts):
    """Every character that no base span covers is in exactly the candidate that holds its whole uncovered run, if that is long enough."""
    text, formats = "".join(parts), secrets.default_formats()
    base = secrets.base_spans(text)
    covered = {k for a, _, b in base for k in range(a, b)}
    want, low = [], None
    for k, c in enumerate([*text, " "]):
        if c in secrets.ALPHABET and k not in covered and k < len(text):
            low = k if low is None else low
            continue
        if low is not None and k - low >= 20 and whole_run(text, low, k) >= 20:
            want.append((low, k))
        low = None
    assert sorted(secrets.candidates(text, base)) == want
    assert formats.spans(text, base, secrets.BITS) == [(a, 3, b) for a, b in want if formats.gain(text[a:b])[0] >= secrets.BITS]


def whole_run(text, a, b):
    while a and text[a - 1] in secrets.ALPHABET:
        a -= 1
    while b < len(text) and text[b] in secrets.ALPHABET:
        b += 1
    return b - a


def test_what_base_spans_leave_of_a_run_is_scored(spark):
    draw = random.Random(12)
    block = "".join(draw.choice(secrets.ALPHABET[:62]) for _ in range(76))
    text = f"see {block}zZ{'0123456789abcdef' * 2}Zz{block[::-1]} end"
    df = spark.createDataFrame([(1, text), (2, "token = '" + "short" + "'"), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in secrets.digest(secrets.find(df)).collect()}
    kinds = [s.split(":")[0] for s in got[1].split(",")]
    assert kinds == ["format", "hex", "format"] and got[2] == got[3] == ""
    assert {r["text"] for r in secrets.redact(df).where("doc_id = 1").collect()} == {"see [secret][secret][secret] end"}
    assert secrets.learn(df.limit(0)) == ([], [])


def test_scan_and_redaction(spark):
    key = "ghp_" + "a1B2c3D4e5F6g7H8i9J0" * 2
    rows = [(1, f'é token = "abcdef123" and {key[:40]} end'), (2, None), (3, ""), (1, "AKIA" + "B" * 16), (4, "ordinary " * 5000 + "f" * 40)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, base string").repartition(2)
    got = {(r["doc_id"], r["spans"]) for r in secrets.digest(secrets.find(df.drop("base"))).collect()}
    assert got == {(1, "assign:2:20,format:26:66"), (2, ""), (3, ""), (1, "access:0:20"), (4, "hex:45000:45040")}
    out = {r["text"] for r in secrets.redact(df).collect()}
    assert out == {'é [secret]" and [secret] end', None, "", "[secret]", "ordinary " * 5000 + "[secret]"} and secrets.redact(df).columns == df.columns
    assert secrets.find(df.limit(0)).count() == 0


def test_secrets_in_runs_over_200(spark):
    draw = random.Random(11)
    key = "".join(draw.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(10_000))
    path = "/".join(["usr", "share", "some", "ordinary", "folder"] * 20) + "/v2"
    df = spark.createDataFrame([(1, f"see {key} there"), (2, f"see {path} there")], "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in secrets.digest(secrets.find(df)).collect()}
    assert len(path) > 200 and got == {1: "format:4:10004", 2: ""}
    assert {r["text"] for r in secrets.redact(df).collect()} == {"see [secret] there", f"see {path} there"}


# Decontamination


@pytest.mark.parametrize("block_words", [10**6, 8])
def test_windows(spark, block_words):
    draw = random.Random(3)
    items = [(k, " ".join(draw.choice("abcd") for _ in range(draw.choice([0, 1, 3, 5, 6, 7, 9])))) for k in range(12)] + [(3, "x y"), (None, "b c x"), (50, None)]
    docs = [(k, " ".join(draw.choice("abcdQ") for _ in range(draw.randint(0, 60)))) for k in range(120)] + [(900, None), (901, "É a-b_c\tD " * 2000)]
    df = spark.createDataFrame([("a", *d, "x", 7) for d in docs], "items string, doc_id long, text string, spans string, n_words int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.find(df, bench, window=5, block_words=block_words)
    found = found.select("doc_id", *[c.alias(n) for n, c in decontamination.digest(found).items()]).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in found}
    assert got == decontamination.op7_brute_force(docs, [("null" if k is None else k, t) for k, t in items], 5)


def test_clashing_columns_and_a_growing_benchmark(spark):
    """Removal keeps a document's own columns, through one automaton and through many alike."""
    draw = random.Random(8)
    items = [(k, " ".join(f"{draw.choice('abc')}{draw.randint(0, 60)}" for _ in range(30))) for k in range(40)]
    docs = [(k, " ".join(f"z{draw.randint(0, 900)}" for _ in range(60)) + " " + (items[k % 40][1] if k % 3 == 0 else ""), "s", "i", 1) for k in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string, spans string, items string, n_words int").repartition(3)
    want = [d for d in docs if d[0] % 3]
    for size in (10**6, 200):
        kept = decontamination.remove(df, spark.createDataFrame(items, "item_id long, text string"), block_words=size)
        assert kept.schema == df.schema and sorted(map(tuple, kept.collect())) == want


def test_time_is_in_proportion_to_repeated_words():
    import time

    def took(n):
        began = time.perf_counter()
        matcher = decontamination.Matcher(13).build([("1", b"same " * n)])
        spans, found = matcher.scan([b"same"] * n)
        assert spans == [(0, n)] and found == {"1"}
        return time.perf_counter() - began

    took(1000)
    assert took(40_000) < 40 * max(took(4_000), 0.005)


def test_removal(spark):
    item = " ".join(f"w{k}" for k in range(20))
    docs = spark.createDataFrame([(1, "clean text"), (2, "x " + item), (3, "Start, " + "pad " * 600 + item.upper() + "! End.")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(r["doc_id"] for r in decontamination.remove(docs, bench).collect()) == [1, 3]
    cut = {r["doc_id"]: r["text"] for r in decontamination.remove(docs, bench, most_words=13).collect()}
    assert cut == {1: "clean text", 3: "Start, " + "pad " * 600 + "End."}
    assert decontamination.remove(docs, bench.limit(0)).count() == 3 and decontamination.remove(docs.limit(0), bench).count() == 0


# Sharding


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 7)
    rows = [(k, "same" if k % 2 else f"text {k}", "hot" if k % 3 else f"s{k % 9}") for k in range(500)] + [(7, None, None), (7, None, None), (None, "é", "hot")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, source string, shard int").repartition(5)
    got = sharding.shard(df, 16).collect()
    again = sharding.shard(df.repartition(2), 16).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again)) and len(got) == len(rows)
    counts = collections.Counter(r["shard"] for r in got)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n)) for s, n in counts.items())
    mixed = collections.Counter((r["source"], r["shard"]) for r in got)
    hot = [mixed["hot", s] for s in range(16)]
    assert max(hot) - min(hot) <= 2
    assert sorted((r["size"], r["text_crc32"]) for r in got) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, _ in rows)
    assert sharding.shard(df.limit(0)).count() == 0 and sharding.shard(df.limit(3), 16).count() == 3


@pytest.mark.parametrize("rows_a_bucket", [3, 4096])
def test_shards_are_a_plain_sort_by_fractional_rank(spark, monkeypatch, rows_a_bucket):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", rows_a_bucket)
    rows = [(k, f"text {k % 40}", "hot" if k % 3 else f"s{k % 7}") for k in range(300)] + [(5, None, None), (6, "x", None), (7, "é", "hot")]
    given = [("null" if s is None else f"={s}", k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t, s in rows]
    place = lambda k, crc: int(hashlib.md5(f"42:{k}:{crc}".encode()).hexdigest()[:13], 16)
    strata, ranked = collections.defaultdict(list), []
    for r in given:
        strata[r[0]].append(r)
    for own in strata.values():
        own.sort(key=lambda r: (place(r[1], r[3]), *r[1:]))
        ranked += [((2 * k + 1) / (2 * len(own)), *r) for k, r in enumerate(own)]
    ranked.sort()
    n = len(ranked)
    want = sorted((doc, size, crc, k * 16 // n, k - -(-(k * 16 // n) * n // 16)) for k, (_, _, doc, size, crc) in enumerate(ranked))
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5), 16).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got) == want


def test_shards_of_more_than_2048_buckets(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 1)
    rows = [(k, f"text {k}", f"s{k % 3}") for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = sharding.shard(df, 16).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(3000))
    counts = collections.Counter(r["shard"] for r in got)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    mixed = collections.Counter((r["source"], r["shard"]) for r in got)
    assert len(mixed) == 48 and max(mixed.values()) - min(mixed.values()) <= 2


# Shared pieces


def test_ranges(spark):
    df = spark.createDataFrame([(k,) for k in [5, 5, 5, -3, 10**12, None, *range(100)]], "k long")
    bounds = key_bounds(df, "k", 8)
    assert len(bounds) < 8
    for r in df.select("k", range_of(F.col("k"), bounds).alias("r")).collect():
        assert r["r"] == (0 if r["k"] is None else sum(b <= r["k"] for b in bounds))
    assert key_bounds(df.limit(0), "k", 8) == []


def test_queries_are_registered():
    assert [n.split("_")[0] for n in queries.QUERIES if not n.startswith("llm_")] == [*(f"op{k}" for k in range(1, 14)), "pipeline"]
    assert set(queries.ORACLES) <= set(queries.QUERIES) and {n for n in queries.QUERIES if n.startswith("llm_")} == set(queries.COLUMN_ORACLES)


def test_pipeline_against_brute_force(spark):
    """Every stage on its own input: what it keeps, and what it makes of it, by plain Python."""
    import corpus_pipeline
    from test_similarity import brute
    from test_tokens import check_packing

    from cadastre.llm import packing

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, before = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == names
        kept.append({r["doc_id"]: r for r in docs.collect()})
        assert docs.count() == len(kept[-1])
    toxic, single, clean, redacted = kept

    model = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"), id_crc("doc_id", 5) != 0)
    assert set(toxic) == {k for k, r in before.items() if model.score(r["text"].encode()) < 0.5}
    groups = brute([(k, r["text"]) for k, r in toxic.items()], 5, 80)
    assert set(single) == {k for k, (_, lead) in groups.items() if k == lead}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = decontamination.op7_brute_force([(k, r["text"]) for k, r in single.items()], items)
    assert set(clean) == {k for k, row in found.items() if not row[4]} and all(clean[k] == single[k] for k in clean)
    assert set(redacted) == set(clean)
    for k, r in redacted.items():
        has = secrets.op6_brute_force(clean[k]["text"])[:3]
        assert r["n_chars"] == len(r["text"]) and (r["text"] == clean[k]["text"] or any(has) or "[secret]" in r["text"]) and not any(secrets.op6_brute_force(r["text"])[:3])

    import public_tokenizers

    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    check_packing(pieces, 4096, [(k, r["text"], r["source"]) for k, r in redacted.items()])
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert sorted(map(tuple, out.select("doc_id", "start", "length", "sequence_id", "offset").collect())) == sorted((p["doc_id"], p["start"], p["length"], p["sequence_id"], p["offset"]) for p in pieces)


def test_decontamination_sql_gives_the_same_rows(spark):
    import duckdb

    con = duckdb.connect()
    for n in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {n} AS SELECT * FROM '{SF}/{n}.parquet'")
    rel = con.sql(queries.ORACLES["op7_decontamination"])
    df = queries.QUERIES["op7_decontamination"](spark, SF)
    assert sorted(map(tuple, df.select(*rel.columns).collect())) == sorted(rel.fetchall())
