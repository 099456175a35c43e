"""A corpus from quality rules to packed sequences, in stages that read what the last one wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidelog import session
from tidelog.llm import decontaminate, divergence, minhash, packing, repeats
from tidelog.llm.common import BATCH_BYTES, ready, table

#: SQL cannot express the operators; the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ready(spark, BATCH_BYTES)
    return divergence.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, over five-word shingles."""
    ready(spark, BATCH_BYTES)
    return minhash.keep_one(docs, words=5, percent=80)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 200 bytes and more that occur more than once."""
    ready(spark, BATCH_BYTES)
    return repeats.strip_repeats(docs, min_bytes=200)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    ready(spark, BATCH_BYTES)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document's tokens in sequences of 4096."""
    ready(spark, BATCH_BYTES)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), kind="words", end_id=1, capacity=4096)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = session.scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
