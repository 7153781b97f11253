"""The corpus pipeline: five stages from raw documents to a mixed training set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkatlas.llm import decontaminate, language, mixing, simhash, substrings
from talkatlas.runtime import stored


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_known(docs)


def first_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def without_recurring_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = substrings.replace_texts(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept


def without_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


# Each stage takes all rows that the one before has kept; all but the last
# return the columns of documents.
STAGES = [
    ("language_id", known_languages),
    ("simhash_near_dedup", first_of_near_duplicates),
    ("substring_dedup", without_recurring_passages),
    ("benchmark_decontamination", without_benchmark_items),
    ("source_mixing", mixed_sources),
]

# Language models and edit distances within documents cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each reads what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
