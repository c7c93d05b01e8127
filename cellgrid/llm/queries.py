"""The registered queries of the corpus operators and, where SQL can express one, its DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from . import (ann_hilbert, chat_format, decontaminate, hard_negatives, importance, license_scan, line_dedup, near_dedup, pii,
               sentencepiece_codec, token_count, toxicity, url_filter)

TOKENIZER = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents after removal of repeated line chunks: doc_id, n_lines, n_removed, text_sha256 of what remains."""
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep_counts=True).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verbatim benchmark windows in every document."""
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("longest")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every vector whose id is divisible by 50."""
    return ann_hilbert.nearest(_table(spark, sf_dir, "embeddings"), k=5, query_step=50)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, domain rule and verdict of every page."""
    return url_filter.judge(_table(spark, sf_dir, "pages"), url_filter.rule_table(spark, url_filter.production_rules()))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over sets of two-word shingles."""
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=2)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document."""
    return pii.report(_table(spark, sf_dir, "documents"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the formatted windows of every conversation hold, read back from them."""
    return chat_format.report(chat_format.planted(_table(spark, sf_dir, "conversations")))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded and decoded documents, as digests."""
    return sentencepiece_codec.report(_table(spark, sf_dir, "documents"), tokenizer_path())


def op9_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document."""
    return token_count.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path())


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of every document."""
    return toxicity.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence tags, notices and base phrases of every document."""
    return license_scan.report(_table(spark, sf_dir, "documents"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document in a draw towards the benchmark's text."""
    return importance.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by 100; every seventh row has the next label."""
    vectors = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), anchor_step=100)


#: n_items are those with a window in the document; all windows of an item are compared with all word positions
OP2_SQL = rf"""
WITH doc AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS r FROM documents),
item AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), {decontaminate.WINDOW}) AS n, array_to_string(w[i:i + least(len(w), {decontaminate.WINDOW}) - 1], ' ') AS win
        FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - {decontaminate.WINDOW - 1}, 1))) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
pos AS (SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS win FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p FROM doc, sizes WHERE len(w) >= n)),
hit AS (SELECT r, item_id, pos.n, p FROM pos JOIN win USING (n, win)),
covered AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(generate_series(p, p + n - 1)) AS q FROM hit) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_line_dedup, op2_decontaminate, op3_neighbours, op4_url_filter, op5_near_dedup, op6_pii,
                            op7_chat_format, op8_sentencepiece, op9_token_count, op10_toxicity, op11_license_scan,
                            op12_importance, op13_hard_negatives)}
ORACLES: dict[str, str] = {"op1_line_dedup": line_dedup.ORACLE_SQL, "op2_decontaminate": OP2_SQL, "op4_url_filter": url_filter.ORACLE_SQL,
                           "op7_chat_format": chat_format.ORACLE_SQL, "op12_importance": importance.ORACLE_SQL,
                           "op13_hard_negatives": hard_negatives.ORACLE_SQL}
