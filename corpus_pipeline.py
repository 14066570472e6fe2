"""The training-data pipeline: documents, stage by stage, to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet
into the shared folder and reads it again for the next. All but the last return the
columns of ``documents``, and each works on all rows that the one before kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cadastre.llm import decontamination, jaccard, packing, secrets, toxicity
from cadastre.llm.common import id_crc, materialise, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model predicts toxic go; labels of held-out ids are not learnt from."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), id_crc("doc_id", 5) != 0)
    return toxicity.reject(docs, model)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by five-word shingles at 0.8 or more, the one with the smallest id stays."""
    return jaccard.keep_one(docs, length=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more lies in benchmark windows go; the rest stay as they are."""
    return decontamination.remove(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with each secret replaced by a mark and n_chars as it then is."""
    out = secrets.redact(docs)
    return out.selectExpr(*[f"CAST(char_length(text) AS {t}) AS n_chars" if c == "n_chars" else f"`{c}`" for c, t in docs.dtypes])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents in sequences of 4096 tokens, sources in proportion."""
    import public_tokenizers

    return packing.digest(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), keep_words=False))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard_join", keep_one_of_similar),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("packing", pack),
]

#: No stage can be said in SQL: a trained model, an automaton, a tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
