"""Input checks: required columns and one-to-one alignment of keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, *names: str) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def alignment_report(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """One row that says how two tables match on ``key``.

    Both key columns go through a single grouping with partial counts, so one
    key with very many rows costs no more than any other.  ``left_only`` and
    ``right_only`` count keys, ``left_repeats`` and ``right_repeats`` rows
    beyond the first of a key.  Null keys match nothing and are counted apart.
    """
    tagged = left.select(
        F.col(key).alias("k"), F.lit(1).alias("l"), F.lit(0).alias("r")
    ).unionByName(
        right.select(F.col(key).alias("k"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    per_key = tagged.groupBy("k").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    known = F.col("k").isNotNull()

    def total(expr):
        return F.coalesce(F.sum(expr), F.lit(0)).cast("bigint")

    return per_key.agg(
        total(F.when(known & (F.col("l") > 0) & (F.col("r") > 0), 1)).alias("matched"),
        total(F.when(known & (F.col("r") == 0), 1)).alias("left_only"),
        total(F.when(known & (F.col("l") == 0), 1)).alias("right_only"),
        total(F.when(known & (F.col("l") > 1), F.col("l") - 1)).alias("left_repeats"),
        total(F.when(known & (F.col("r") > 1), F.col("r") - 1)).alias("right_repeats"),
        total(F.when(~known, F.col("l") + F.col("r"))).alias("null_keys"),
    )


def require_aligned(left: DataFrame, right: DataFrame, key: str = "id") -> None:
    """Raise unless every key occurs exactly once on both sides."""
    report = alignment_report(left, right, key).first().asDict()
    report.pop("matched")
    bad = {name: n for name, n in report.items() if n}
    if bad:
        raise ValueError(f"tables do not align on {key}: {bad}")
