"""Preparation of a training corpus: five stages, each on all rows the one before it kept.

Every stage takes (spark, docs, folder of the tables) and returns a DataFrame with the columns of
documents; the last returns the mixture. ``run`` writes each result as Parquet to the shared folder and
reads it for the next stage. Null ids, null and empty texts, repeated rows and empty tables are handled
as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillsift.llm import decontaminate, jaccard, language, mixing, pii
from quillsift.session import written


def language_id(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops texts without a letter and those whose language stays unclear."""
    return language.keep_known(docs, language.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps the document of the smallest id of each class."""
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Replaces personal data by its kind."""
    return pii.redact(docs, pii.train(docs))


def mixture(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents the mix takes, with their complete epochs, size and words taken."""
    return mixing.mixture(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixture", mixture),
]

# Learned models and similarity classes aren't SQL; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, folder), name)
    return docs
