"""The corpus pipeline: language ID, exact and near deduplication, decontamination, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagemill.lineage import settle
from pagemill.llm import decontaminate, exact_dedup, langid, mixing, near_dedup


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is clearly of one language."""
    return langid.accepted(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.distinct_texts(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_dedup.one_per_class(docs)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per copy of each document that is taken."""
    return mixing.mix(docs)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("decontamination", contamination),
    ("mixing", mixture),
]

# Learned scores, sampled signatures and greedy rounding are beyond SQL; tests/llm holds the
# rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(spark, lambda: stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
