"""The operators of this folder as queries over the given tables, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkatlas.llm import (
    chat,
    decontaminate,
    language,
    mixing,
    pages,
    periodic,
    quality,
    search,
    simhash,
    substrings,
    suffixes,
    topk,
    vectors,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substrings.remove_recurring(_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(spark, _table(spark, sf_dir, "documents"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffixes.remove_repeated(_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.drawn(_table(spark, sf_dir, "documents"))
    taken = F.col("size") * F.size("draws")
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_probe(spark, _table(spark, sf_dir, "conversations"))
    return chat.digests(chat.conversations(rows))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(docs, items)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    texts = docs.select("doc_id", periodic.with_periodic_tail(F.col("doc_id"), F.col("text")).alias("text"))
    return periodic.digests(periodic.periodic_runs(texts))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_language_id,
        op3_suffix_array_dedup,
        op4_simhash_near_dedup,
        op5_source_mixing,
        op6_chat_formatting,
        op7_benchmark_decontamination,
        op8_quality_classifier,
        op9_embedding_near_dedup,
        op10_html_extraction,
        op11_top_products,
        op12_periodic_runs,
        op13_ranked_search,
    )
}

ORACLES: dict[str, str] = {
    "op5_source_mixing": mixing.ORACLE,
    "op6_chat_formatting": chat.ORACLE,
    "op11_top_products": topk.ORACLE,
    "op13_ranked_search": search.ORACLE,
}
