import re

from pyspark.sql import functions as F

from talkatlas import runtime


def test_a_join_beyond_the_bound_copies_frequent_keys_only(spark, monkeypatch):
    monkeypatch.setattr(runtime, "HOT_ROWS", 100)
    n = 5000
    rows = spark.range(0, 3 * n, 1, 8).select(
        F.when(F.col("id") % 7 == 0, F.lit(3)).when(F.col("id") % 11 != 0, F.col("id") % (2 * n)).alias("k"), F.col("id").alias("row")
    )
    small = runtime.stored(spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v")))
    for how in ("left", "inner"):
        found = runtime.join_small(rows, small, "k", how)
        plan = found._jdf.queryExecution().executedPlan().toString()
        # A table that is small on disk is not broadcast: its copies are larger.
        assert re.search(r"SortMergeJoin \[k#\d+L?, _salt", plan)
        plain = rows.join(small, "k", how)
        assert found.columns == plain.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    spread, copies = runtime._salted(rows, small, "k")
    assert copies.count() == n + 3
    by_salt = {r["k"]: r["salts"] for r in spread.groupBy("k").agg(F.countDistinct("_salt").alias("salts")).where("salts > 1").collect()}
    assert by_salt == {3: 4, None: 4}
