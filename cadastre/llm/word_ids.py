"""Token ids of whole texts through the word-level tokenizer, with each word encoded once.

The tokenizer splits at white space and then at letter, digit and other runs, and nothing
it does reaches across such a boundary. So a text's ids are the joined ids of its
white-space-separated chunks, and a chunk's those of its runs; both are cached. Runs not
seen before go through the tokenizer together, and the word-end mark of the last token of
each run shows where its ids end. A chunk outside the plain alphabet, where normalisation
could join characters, goes through the tokenizer as it is. Chunks are cached with A-Z
lowered, but for one: normalisation joins a letter with the mark after it before the tokenizer
lowers it, so a chunk with a capital before what may be a mark keeps its capitals.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import regex

#: Fixed value: the split pattern of the tokenizer.
RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters that normalise one by one, and whose classes both regex engines agree on.
PLAIN = "[\\x21-\\x7e¡-įı-ɏ]+"
#: Marks that end a chunk as a run of their own after letters.
MARKS = (b".", b",", b";", b":", b"!", b"?")
#: A capital with a code point from U+0300 on after it, in UTF-8.
find_joined = re.compile(rb"[A-Z][\xcc-\xf4]").search
CHUNKS_CACHED, RUNS_CACHED, TOGETHER = 1_000_000, 700_000, 500


def chunks_of(text: bytes) -> list[bytes]:
    """White-space-separated chunks as the cache has them."""
    if text.isascii() or not find_joined(text):
        return text.lower().split()
    return [c if find_joined(c) else c.lower() for c in text.split()]


class WordIds:
    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The same model without the normaliser and the pattern, for runs that need neither.
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = None
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        if not all(t.content.startswith("<|") for t in self.tokenizer.get_added_tokens_decoder().values()):
            raise ValueError("a special token without the expected mark")
        self.runs_of, self.plain = regex.compile(RUNS).findall, regex.compile(PLAIN).fullmatch
        self.chunks: dict[bytes, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def pack(self, ids: list[int]) -> bytes:
        return np.asarray(ids, self.dtype).tobytes()

    def whole(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def learn_runs(self, runs: list[str]) -> None:
        width = self.dtype.itemsize
        for k in range(0, len(runs), TOGETHER):
            some = runs[k : k + TOGETHER]
            ids = np.array(self.bare.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.dtype)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(some) or stops[-1] != len(ids):
                self.runs.update((r, self.whole(r)) for r in some)
                continue
            raw, stops = ids.tobytes(), (stops * width).tolist()
            self.runs.update(zip(some, map(raw.__getitem__, map(slice, [0, *stops[:-1]], stops)), strict=True))

    def learn(self, chunks: list[bytes]) -> None:
        """Ids of chunks, as ``chunks_of`` gives them, into the cache."""
        words: list[tuple[bytes, str]] = []
        marked: list[tuple[bytes, str, str]] = []
        split: list[tuple[bytes, list[str]]] = []
        for raw in chunks:
            if raw.isalpha():
                words.append((raw, raw.decode()))
            elif raw[-1:] in MARKS and raw[:-1].isalpha():
                marked.append((raw, raw[:-1].decode(), raw[-1:].decode()))
            else:
                word = raw.decode()
                if self.plain(word):
                    split.append((raw, self.runs_of(word.lower())))
                else:
                    self.chunks[raw] = self.whole(word)
        if len(self.runs) > RUNS_CACHED:
            self.runs.clear()
        new = {w for _, w in words}
        new.update(w for _, w, _ in marked)
        new.update(m for _, _, m in marked)
        new.update(itertools.chain.from_iterable(rs for _, rs in split))
        self.learn_runs(list(new.difference(self.runs)))
        runs = self.runs
        self.chunks.update((raw, runs[w]) for raw, w in words)
        self.chunks.update((raw, runs[w] + runs[m]) for raw, w, m in marked)
        self.chunks.update((raw, b"".join([runs[r] for r in rs])) for raw, rs in split)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Packed ids, little-endian in ``dtype``, of UTF-8 texts."""
        done: list[bytes] = []
        for k in range(0, len(texts), 256):
            some = texts[k : k + 256]
            words = [() if b"<|" in t else chunks_of(t) for t in some]
            if len(self.chunks) > CHUNKS_CACHED:
                self.chunks.clear()
            new = set(itertools.chain.from_iterable(words)).difference(self.chunks)
            if new:
                self.learn(list(new))
            get = self.chunks.__getitem__
            # What may hold a special token's string is not lowered first: its case tells.
            done += [b"".join(map(get, w)) if w else self.whole(t.decode()) if b"<|" in t else b"" for t, w in zip(some, words, strict=True)]
        return done

    def forget(self) -> None:
        """Empty the caches, for a process that goes on to other work."""
        self.chunks, self.runs = {}, {}


_encoders: dict[str, WordIds] = {}


def encoder(path: str) -> WordIds:
    """One per Python process."""
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]
