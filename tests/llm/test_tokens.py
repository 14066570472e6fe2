"""Token counts, id files, packing: against the tokenizers library, whole texts, every case of null, empty and repeated."""

from __future__ import annotations

import random
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cadastre.llm import id_files, packing, token_counts, word_ids

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ROWS = [(1, "Hello world's  end.\n\n 12345", "a"), (2, None, "a"), (3, "", None), (4, "été ñandú <|endoftext|> x", "b"), (4, "été ñandú <|endoftext|> x", "b"), (None, "no id, 日本語 ﬁ", "b"), (7, "word " * 3000, "a"), (8, "x" * 20000, "c")]


def table(spark):
    return spark.createDataFrame([(*r, "kept", 5) for r in ROWS], "doc_id long, text string, source string, n_tokens string, part int").repartition(3)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_agreed_characters():
    counter = token_counts.counter(BYTE)
    for code in range(token_counts.LAST_AGREED + 1):
        c = chr(code)
        s = f"a{c}b {c} 1{c}2 {c}{c}x  {c}'s{c}"
        assert counter.split(s) == [s[a:b] for _, (a, b) in counter.tokenizer.pre_tokenizer.pre_tokenize_str(s)], hex(code)


def test_shortcut_is_proved():
    whole = token_counts.counter(BYTE).whole
    reference = Tokenizer.from_file(BYTE)
    assert len(whole) > 40_000 and all(len(reference.encode(s).ids) == 1 for s in list(whole)[::97])


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200) | st.text("abcdeXYZ '.,!<|>endoftx\n\t\x1c\x85\xa0éñİß́12", max_size=200))
def test_any_text(text):
    counter, words = token_counts.counter(BYTE), word_ids.encoder(WORD)
    assert counter.count(text) == len(counter.tokenizer.encode(text, add_special_tokens=False).ids)
    assert words.encode([text.encode()]) == [words.pack(Tokenizer.from_file(WORD).encode(text, add_special_tokens=False).ids)]


def test_capitals_before_marks():
    """Every capital with every combining mark, and what lower-casing turns into more than one character."""
    marks = [chr(c) for c in range(0x250, 0x2000) if unicodedata.combining(chr(c))]
    texts = [c + m for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for m in marks] + ["J\u030cA \u017d j\u030c", "\u039f\u03a3 A\u03a3 \u03a3.", "\u0130I \u0130\u0301 x\u0130"]
    draw = random.Random(5)
    some = "ABCJHTWYabjhtw 's.,1\t\u0085\u0130\u03a3\u212a" + "".join(draw.sample(marks, 20)) + "\u030c\u0331\u0308\u030a"
    texts += ["".join(draw.choice(some) for _ in range(draw.randint(1, 12))) for _ in range(20_000)]
    words, reference = word_ids.encoder(WORD), Tokenizer.from_file(WORD)
    want = [words.pack(e.ids) for e in reference.encode_batch(texts, add_special_tokens=False)]
    assert words.encode([t.encode() for t in texts]) == want


def test_queries_against_the_library(spark):
    """op1, op3 and op10 as registered, over whole tables."""
    sf = "/root/testdata/sf0.001"
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    reference, byte_level = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    ids = {k: reference.encode(t, add_special_tokens=False).ids for k, t in docs}
    want, start = [], 0
    for k, _ in docs:
        want.append((k, start, len(ids[k]) + 1, crc([*ids[k], 1])))
        start += len(ids[k]) + 1
    assert sorted(map(tuple, id_files.op10_id_files(spark, sf).collect())) == want
    counts = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.op1_token_counts(spark, sf).collect()}
    assert counts == {k: (len(t.encode()), n := len(byte_level.encode(t, add_special_tokens=False).ids), n > 512) for k, t in docs}
    seen = {}
    for p in packing.op3_packing(spark, sf).collect():
        own = [*ids[p["doc_id"]], 2]
        assert p["doc_tokens"] == len(own) and p["ids_crc32"] == crc(own[p["start"] : p["start"] + p["length"]])
        seen.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
    assert all(sum(n for _, n in v) == len(ids[k]) + 1 and len({a for a, _ in v}) == len(v) for k, v in seen.items()) and set(seen) == set(ids)


def test_ids_of_any_integer_type(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (2, None, "y")], "doc_id int, text string, source string")
    assert packing.pack(df, WORD).count() == 2 and id_files.read_id_files(id_files.write_id_files(df, WORD)).count() == 2


def test_counts(spark):
    reference = Tokenizer.from_file(BYTE)
    out = token_counts.count_tokens(table(spark), BYTE, limit=100)
    assert out.columns == ["doc_id", "source", "part", "n_bytes", "n_tokens", "over_limit"]
    got = sorted((r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in out.collect())
    want = sorted((len((t or "").encode()), n := len(reference.encode(t or "").ids), n > 100) for _, t, _ in ROWS)
    assert got == want
    assert token_counts.count_tokens(table(spark).limit(0), BYTE).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=50), st.lists(st.lists(st.integers(0, 49407), max_size=30), max_size=6))
def test_block_round_trip(numbers, docs):
    ranks = np.array(numbers, np.uint32)
    control, data = id_files.write_ranks(ranks)
    assert (id_files.read_ranks(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(ranks)) == ranks).all()
    ids = [np.array(d, np.uint32) for d in docs]
    names = [None if k % 3 == 2 else k - 1 for k in range(len(ids))]
    back, lengths, joined = id_files.read_block(id_files.write_block(names, ids))
    assert back == names and lengths.tolist() == [len(d) for d in docs] and joined.tolist() == [x for d in docs for x in d]


def test_common_ids_take_one_byte():
    ids = np.array([40_000] * 1000 + list(range(300)), np.uint32)
    assert id_files.read_block(id_files.write_block([1], [ids]))[2].tolist() == ids.tolist()
    assert len(id_files.write_ranks(np.zeros(1000, np.uint32))[1]) == 1000


@pytest.mark.parametrize("block_ids", [5, 10**6])
def test_id_files(spark, block_ids):
    reference = Tokenizer.from_file(WORD)
    files = id_files.write_id_files(table(spark), WORD, block_ids=block_ids)
    got = [tuple(r) for r in id_files.id_digests(id_files.read_id_files(files)).orderBy("start").collect()]
    want, start = [], 0
    for doc, text, _ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*reference.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    assert got == want
    assert id_files.read_id_files(id_files.write_id_files(table(spark).limit(0), WORD)).count() == 0


def check_packing(pieces, window, rows=ROWS):
    reference, sequences, documents = Tokenizer.from_file(WORD), {}, {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        documents.setdefault((p["doc_id"], p["doc_tokens"], p["source"]), []).append((p["start"], p["length"], bytes(p["ids"])))
    for text in rows:
        ids = np.array([*reference.encode(text[1] or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        own = sorted(documents[(text[0], len(ids) // 4, text[2])])
        copies = sum(r == text for r in rows)
        assert sum(n for _, n, _ in own) * 4 == len(ids) * copies
        if copies == 1:
            assert b"".join(raw for _, _, raw in own) == ids
    lengths = []
    for number in range(len(sequences)):
        end = 0
        for offset, n in sorted(sequences[number]):
            assert offset == end
            end += n
        lengths.append(end)
    tail = [n for n in lengths if n != window]
    assert all(n & (n - 1) == 0 for n in tail) and lengths == [window] * (len(lengths) - len(tail)) + tail


@pytest.mark.parametrize("weights", [None, {"a": 1, "b": 3, "c": 2, None: 1}, {"b": 1}])
def test_packing(spark, weights):
    check_packing(packing.pack(table(spark), WORD, window=64, weights=weights).collect(), 64)


def test_windows_hold_the_mixture(spark):
    rows = [(k, "alpha beta gamma delta " * 5, "ab"[k % 4 == 0]) for k in range(400)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string"), WORD, window=128).collect()
    share = {}
    for p in pieces:
        share.setdefault(p["sequence_id"], {}).setdefault(p["source"], []).append(p["length"])
    full = [s for s in share.values() if sum(map(sum, s.values())) == 128]
    assert len(full) > 50 and all(abs(sum(s["b"]) - 32) <= 1 for s in full)


def test_more_sources_than_a_window_has_tokens(spark):
    rows = [(k, "a b", f"s{k}") for k in range(100)] + [(200, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check_packing(packing.pack(df, WORD, window=16).collect(), 16, rows)
    assert packing.pack(df.limit(0), WORD).count() == 0


def test_sequences(spark):
    whole = packing.sequences(packing.pack(table(spark), WORD, window=64)).collect()
    assert all(len(r["ids"]) == 4 * r["length"] for r in whole) and sum(r["length"] for r in whole) > 3000


def test_targets_hold_with_more_sources_than_queues(spark):
    rows = [(k, "word " * 40, f"s{k % 30}") for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    weights = {"s1": 3, "s2": 1, "absent": 5}
    pieces = packing.pack(df, WORD, window=16, weights=weights).collect()
    check_packing(pieces, 16, rows)
    # 4 windows are far from the end of any of the two: 3 parts s1, one part s2, to a token, and none of the others.
    first = [p for p in pieces if p["sequence_id"] < 4]
    given = {s: sum(p["length"] for p in first if p["source"] == s) for s in {p["source"] for p in first}}
    assert set(given) == {"s1", "s2"} and abs(given["s1"] - 48) <= 1
    # Targets under a token a window add up in a queue of their own, ahead of sources without one.
    many = {f"s{k}": 1 for k in range(29)}
    pieces = packing.pack(df, WORD, window=16, weights=many).collect()
    check_packing(pieces, 16, rows)
    last = max(p["sequence_id"] for p in pieces if p["length"] == 16)
    assert all(p["sequence_id"] > last // 2 for p in pieces if p["source"] == "s29")


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 200), min_size=1), st.sampled_from([None, {"a": 1.0, "b": 2.5, "c": 0.5}]), st.sampled_from([4, 16]))
def test_plan_places_every_token_once(tokens, weights, window):
    phases, total, seen = packing.plan(tokens, weights, window), sum(tokens.values()), set()
    for queue, n in tokens.items():
        if n:
            found = [p for at in range(0, n, 7) for p in packing.pieces(phases, queue, at, min(7, n - at), window, total)]
            for _, length, sequence, offset in found:
                for k in range(length):
                    seen.add((sequence, offset + k))
    assert len(seen) == total
