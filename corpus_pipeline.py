"""A corpus from raw documents to ids in five stages, each written and read again."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dispatchlens import session
from dispatchlens.llm import decontaminate, jaccard, pieces, quality, secrets
from dispatchlens.llm.queries import PIECES, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.kept(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of least id."""
    return jaccard.distinct_documents(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by their kind."""
    return secrets.redacted(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's ids, and whether they decode to its text."""
    return pieces.digests(docs, public_tokenizers.path(PIECES))


STAGES = [("quality_rules", good), ("ngram_jaccard_join", distinct), ("benchmark_decontamination", clean), ("secret_scan", masked), ("sentencepiece", encoded)]
#: The join's components and the merges of pieces can't be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = session.run_path(spark, f"{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
