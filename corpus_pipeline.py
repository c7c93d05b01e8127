"""The corpus pipeline: toxicity, repeated lines, near duplicates, benchmark passages, token ids.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all documents that its predecessor kept; its result is written
and read again before the next one.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellgrid.llm import decontaminate, line_dedup, near_dedup, sentencepiece_codec, toxicity
from cellgrid.llm.queries import tokenizer_path
from cellgrid.session import scratch_path, ship_package


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models do not reject; they learn from the labels of the documents they are given."""
    ship_package(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.remove_toxic(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated line chunks; one of which nothing is left goes."""
    clean = line_dedup.dedup_lines(docs, keep_counts=True)
    return _with_length(clean.filter((F.col("n_removed") < F.col("n_lines")) | (F.col("n_lines") == 0)).drop("n_lines", "n_removed"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return near_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document: doc_id, n_tokens, ids."""
    return (sentencepiece_codec.encode(docs.select("doc_id", "text"), tokenizer_path())
            .select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("near_dedup", drop_near_duplicates),
          ("decontaminate", drop_contaminated), ("sentencepiece", encode_pieces)]

#: SQL cannot express the models, the similarity search or the tokenizer; tests/llm holds the brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared scratch folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    run_id = uuid.uuid4().hex[:12]
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{run_id}", name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
