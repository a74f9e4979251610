"""Corpus pipeline: good, distinct, uncontaminated documents, encoded.

Each stage takes (spark, docs, sf_dir) and works on all rows of the stage before
it, which were written as Parquet and read again. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lapstats.llm import decontaminate, exact_dedup, quality_nbsvm, queries, simhash
from lapstats.llm.common import table
from lapstats.session import materialize


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_nbsvm.keep_good(docs, queries.quality_model(spark, docs, sf_dir), queries.GOOD)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each normalised text."""
    return exact_dedup.keep_first(docs)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs, width=4, distance=4)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids, and of what they decode to."""
    return queries.token_digests(docs)


STAGES = [
    ("quality_classifier", good),
    ("exact_dedup", distinct),
    ("simhash_near_dedup", unlike),
    ("benchmark_decontamination", uncontaminated),
    ("bpe_encoding", encoded),
]

#: Fingerprints, margins and merges have no SQL; tests/llm/test_pipeline.py checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
