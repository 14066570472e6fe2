"""The registered queries of the training-data operators, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .decontamination import OP7_SQL, op7_decontamination
from .divergence import OP11_SQL, op11_source_audit
from .fingerprints import op8_fingerprints
from .id_files import op10_id_files
from .jaccard import OP4_SQL, op4_jaccard_join
from .packing import op3_packing
from .scoring import op2_lm_scoring
from .sharding import op9_sharding
from .secrets import op6_secret_scan
from .simhash import op13_simhash_dedup
from .spelling import OP12_SQL, op12_spelling_variants
from .token_counts import op1_token_counts
from .toxicity import op5_toxicity


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


#: Columns of operators whose other columns SQL cannot tell, each through its operator's own query.


def llm_base_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op2 counts and its base score, to four decimals since sums of doubles depend on their order.

    None of these depends on longer histories, so op2 runs with its automaton's root alone.
    """
    return op2_lm_scoring(spark, sf_dir, history=0).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"))


def llm_base_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op6 counts of the base patterns."""
    return op6_secret_scan(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex")


def llm_edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which texts op8 compares."""
    return op8_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def llm_shard_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows and bytes op9 deals, and that slots have no gaps."""
    dealt = op9_sharding(spark, sf_dir).groupBy("shard").agg(F.count("*").alias("rows"), F.min("slot").alias("first"), F.max("slot").alias("last"), F.count_distinct("slot").alias("slots"), F.sum("size").alias("size"))
    return dealt.withColumn("size", F.sum("size").over(Window.partitionBy()))


CRC_SQL = """bytes AS (SELECT b, b::BIGINT AS v, 0 AS k FROM range(256) t(b) UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bytes WHERE k < 8),
crc AS (SELECT list(v ORDER BY b) AS steps FROM bytes WHERE k = 8)"""
LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
COLUMN_ORACLES = {
    "llm_base_scores": rf"""WITH RECURSIVE {CRC_SQL},
    d AS (SELECT doc_id, hex(encode(doc_id::VARCHAR)) AS h, list_append(regexp_extract_all({LOWER_SQL}, '[^ 	-
]+'), chr(0) || 'end') AS tokens FROM documents),
    r AS (SELECT doc_id, tokens, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT)), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) % 5 = 1 AS held_out FROM d, crc),
    t AS (SELECT doc_id, held_out, unnest(tokens) AS token FROM r),
    c AS (SELECT token, count(*) AS c FROM t WHERE NOT held_out GROUP BY token), n AS (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS n, count(*) AS v FROM c)
    SELECT doc_id, held_out, count(*) AS n_tokens, count(c.c) AS n_known, any_value(n.n) AS train_tokens, round(sum(log10((coalesce(c.c, 0) + 0.5::DOUBLE) / (n.n + 0.5::DOUBLE * (n.v + 1)))), 4) AS base_score FROM t LEFT JOIN c ON c.token = t.token, n GROUP BY doc_id, held_out""",
    "llm_base_secrets": r"""SELECT doc_id, CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']? *[:=] *["'']?([A-Za-z0-9+/_.=-]+)', 2), lambda x: length(x) >= 6)) AS BIGINT) AS n_assign,
    CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 20)) AS BIGINT) AS n_access, CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: length(x) >= 24)) AS BIGINT) AS n_hex FROM documents""",
    "llm_edited_texts": """WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id), first_value(coalesce(text, '')) OVER (ORDER BY doc_id)) AS next FROM documents)
    SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(left(text, length(text) - length(text) // 4) || left(next, length(text) // 4)) AS edited_sha256 FROM d""",
    "llm_shard_sizes": """WITH n AS (SELECT count(*) AS n, CAST(sum(octet_length(encode(coalesce(text, ''))) + 1) AS BIGINT) AS size FROM documents), s AS (SELECT s, ((s + 1) * n + 15) // 16 - (s * n + 15) // 16 AS rows, size FROM n, range(16) t(s))
    SELECT CAST(s AS INTEGER) AS shard, CAST(rows AS BIGINT) AS "rows", CAST(0 AS BIGINT) AS first, CAST(rows - 1 AS BIGINT) AS last, CAST(rows AS BIGINT) AS slots, size FROM s WHERE rows > 0""",
}


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_packing": op3_packing,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_toxicity": op5_toxicity,
    "op6_secret_scan": op6_secret_scan,
    "op7_decontamination": op7_decontamination,
    "op8_fingerprints": op8_fingerprints,
    "op9_sharding": op9_sharding,
    "op10_id_files": op10_id_files,
    "op11_source_audit": op11_source_audit,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_simhash_dedup": op13_simhash_dedup,
    "pipeline": pipeline,
    "llm_base_scores": llm_base_scores,
    "llm_base_secrets": llm_base_secrets,
    "llm_edited_texts": llm_edited_texts,
    "llm_shard_sizes": llm_shard_sizes,
}

ORACLES: dict[str, str] = {"op4_jaccard_join": OP4_SQL, "op7_decontamination": OP7_SQL, "op11_source_audit": OP11_SQL, "op12_spelling_variants": OP12_SQL} | COLUMN_ORACLES
