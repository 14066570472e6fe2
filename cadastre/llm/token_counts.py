"""Token counts by the whole-token shortcut.

A byte-level BPE splits a text into pre-tokens and merges within each. Before any row is
read, every vocabulary string is encoded alone, and those that come back as exactly their
own id are kept: a pre-token equal to one of them counts as one token without any merge.
Only the remaining pre-tokens are given to the tokenizer, once each while they stay cached.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_bytes

#: Fixed value: the split pattern of the tokenizer's ByteLevel step.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Up to here the regex library and the tokenizer agree on every character's class (tests/llm
#: compares all of them); a text with a character beyond it is split by the tokenizer itself.
LAST_AGREED = 0x4FF
CACHED = 400_000


class TokenCounter:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.split = regex.compile(PRE_TOKENS).findall
        self.beyond = regex.compile(f"[^\\x00-{chr(LAST_AGREED)}]").search
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = self.prove()
        self.known = dict(self.whole)

    def prove(self) -> dict[str, int]:
        """Vocabulary strings that alone encode to their own single id and stay one pre-token."""
        decode = self.tokenizer.decoder.decode
        strings = {decode([token]): i for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        strings = {s: i for s, i in strings.items() if "�" not in s and s}
        found = self.tokenizer.encode_batch_fast(list(strings), add_special_tokens=False)
        return {s: 1 for (s, i), e in zip(strings.items(), found, strict=True) if e.ids == [i] and self.split(s) == [s]}

    def merge(self, piece: str) -> int:
        n = len(self.tokenizer.model.tokenize(self.tokenizer.pre_tokenizer.pre_tokenize_str(piece)[0][0]))
        if len(self.known) > len(self.whole) + CACHED:
            self.known = dict(self.whole)
        self.known[piece] = n
        return n

    def pieces(self, text: str) -> list[str]:
        if self.beyond(text):
            return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        return self.split(text)

    def count(self, text: str) -> int:
        if any(s in text for s in self.special):
            # Added tokens are cut out before the split and change what their neighbours see.
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        get, merge, n = self.known.get, self.merge, 0
        for piece in self.pieces(text):
            n += get(piece) or merge(piece)
            get = self.known.get
        return n


_counters: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """One per Python process: the proof takes a fraction of a second."""
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, tokenizer_path: str, *, text: str = "text", limit: int = 512) -> DataFrame:
    """Every row of ``docs`` without its text, with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    A null or empty text has no bytes and no tokens. Rows are independent: repeated rows and
    null ids are kept, other columns pass through, and a column named like a result is replaced.
    """
    made = {"n_bytes", "n_tokens", "over_limit"}
    kept = [c for c in docs.columns if c != text and c not in made]
    given = docs.select(*kept, text_bytes(text).alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1]] + ["n_bytes long", "n_tokens long", "over_limit boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer_path).count
        for batch in batches:
            raw = batch.column(batch.num_columns - 1)
            tokens = [count(x.as_py().decode()) for x in raw]
            sizes = [len(x.as_buffer()) for x in raw]
            columns = [*batch.columns[:-1], pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n_bytes", "n_tokens", "over_limit"])

    return given.mapInArrow(run, schema)


def op1_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text"))
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
