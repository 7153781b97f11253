from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkatlas import checks
from talkatlas.operators import cluster
from talkatlas.runtime import join_small, row_blocks, top_n_per_group

VECTORS = "id BIGINT, cluster_id INT, embedding ARRAY<FLOAT>"


def vector_table(spark, values, labels=None, parts=5):
    labels = [0] * len(values) if labels is None else labels
    rows = [(i, None if c is None else int(c), v.tolist()) for i, (c, v) in enumerate(zip(labels, values, strict=True))]
    return spark.createDataFrame(rows, VECTORS).repartition(parts)


@pytest.fixture
def values():
    return np.random.default_rng(3).normal(size=(120, 5)).astype(np.float32)


def test_choose_k(spark):
    cases = {0: 3, 100: 3, 149: 3, 300: 6, 1000: 20, 2000: 40, 10000: 40}
    assert {n: cluster.choose_k(n) for n in cases} == cases
    df = spark.createDataFrame([(n,) for n in cases], "n BIGINT")
    assert dict(map(tuple, df.select("n", cluster.choose_k_expr(F.col("n"))).collect())) == cases


def test_labels_that_are_not_numbers_are_left_out(spark):
    labels = ["3", " 1 ", "2.0", "x", None, "NaN", "3"]
    df = spark.createDataFrame([(c,) for c in labels], "cluster_id STRING")
    assert [r[0] for r in cluster.cluster_ids(df).collect()] == [1, 2, 3]


def test_centroids_and_sizes(spark, values):
    labels = [None if i % 10 == 9 else i % 3 for i in range(120)]
    df = vector_table(spark, values, labels)
    for row in cluster.centroids(df).collect():
        members = values[[c == row["cluster_id"] for c in labels]].astype(float)
        assert row["n"] == len(members)
        np.testing.assert_allclose(row["centroid"], members.mean(axis=0), atol=1e-12)
    counts = [r["count"] for r in cluster.cluster_sizes(df).collect()]
    assert counts == sorted(counts, reverse=True) and sum(counts) == 120


@pytest.mark.parametrize("block_rows", [4096, 2])
def test_every_row_goes_to_its_nearest_centroid(spark, values, block_rows, monkeypatch):
    monkeypatch.setattr(cluster, "row_blocks", partial(row_blocks, block_rows=block_rows))
    centers = np.vstack([values[:6], values[2]])  # the last is a copy: ties go to the lower id
    points = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centers)], "cluster_id INT, centroid ARRAY<DOUBLE>")
    rows = cluster.assign_nearest(vector_table(spark, values), points).collect()
    gaps = np.linalg.norm(values[:, None].astype(float) - centers[None], axis=2)
    assert len(rows) == 120
    for row in rows:
        assert row["cluster_id"] == gaps[row["id"]].argmin()
        assert row["distance"] == pytest.approx(gaps[row["id"]].min(), abs=1e-9)


@pytest.mark.parametrize("large", [False, True])
def test_lloyd_steps(spark, values, large, monkeypatch):
    monkeypatch.setattr(cluster, "is_small", lambda df: not large)
    # The last start point attracts nothing and has to stay where it is.
    start = np.vstack([values[:4].astype(float), np.full(5, 100.0)])
    points = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(start)], "cluster_id INT, centroid ARRAY<DOUBLE>")
    found = {r["cluster_id"]: r for r in cluster.lloyd(vector_table(spark, values), points, 3).collect()}
    for _ in range(3):
        label = np.linalg.norm(values[:, None] - start[None], axis=2).argmin(axis=1)
        start = np.array([values[label == i].mean(axis=0, dtype=float) if (label == i).any() else start[i] for i in range(5)])
    for i in range(5):
        np.testing.assert_allclose(found[i]["centroid"], start[i], atol=1e-9)
        assert found[i]["n"] == (label == i).sum()


def test_kmeans_labels(spark):
    rng = np.random.default_rng(0)
    values = np.vstack([rng.normal(c, 0.05, size=(n, 4)) for c, n in ((0, 20), (5, 50), (-5, 30))]).astype(np.float32)
    labels, k = cluster.fit_kmeans(vector_table(spark, values).drop("cluster_id"))
    found = {r["id"]: r["cluster_id"] for r in labels.collect()}
    assert k == 3
    assert [found[i] for i in range(100)] == [2] * 20 + [0] * 50 + [1] * 30


def test_kmeans_with_fewer_rows_than_k(spark):
    labels, k = cluster.fit_kmeans(vector_table(spark, np.eye(2, dtype=np.float32), parts=1))
    assert k == 2 and labels.count() == 2
    labels, k = cluster.fit_kmeans(vector_table(spark, np.eye(1, dtype=np.float32), parts=1))
    assert k == 1 and labels.first()["cluster_id"] == 0
    with pytest.raises(ValueError, match="no rows"):
        cluster.fit_kmeans(spark.createDataFrame([], VECTORS))


def test_alignment(spark):
    left = spark.createDataFrame([(i,) for i in (1, 2, 3, 3, None)], "id INT")
    right = spark.createDataFrame([(i,) for i in (2, 3, 4)], "id INT")
    report = checks.alignment_report(left, right).first().asDict()
    assert report == {"matched": 2, "left_only": 1, "right_only": 1, "left_repeats": 1, "right_repeats": 0, "null_keys": 1}
    with pytest.raises(ValueError, match="do not align on id"):
        checks.require_aligned(left, right)
    checks.require_aligned(right, right)


def test_top_n_of_a_hot_group(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("g"), (F.col("id") * 7919 % 3001).alias("v")
    )
    found = top_n_per_group(df.repartition(9), "g", [F.col("v")], 4).where("g = -1").orderBy("rank").collect()
    expected = sorted(i * 7919 % 3001 for i in range(3000) if i % 3)[:4]
    assert [(r["v"], r["rank"]) for r in found] == [(v, i + 1) for i, v in enumerate(expected)]


@pytest.mark.parametrize("bound", [None, 2, 10_000])
def test_join_small_keeps_every_row(spark, bound):
    rows = spark.range(100).select("id", (F.col("id") % 4).alias("k")).repartition(7)
    small = spark.createDataFrame([(0, "a"), (1, "b")], "k BIGINT, v STRING")
    found = join_small(rows, small, "k", "left", bound).orderBy("id").collect()
    assert [(r["id"], r["v"]) for r in found] == [(i, {0: "a", 1: "b"}.get(i % 4)) for i in range(100)]


def test_row_blocks_cover_a_large_table(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    blocks = list(row_blocks(df, "k", block_rows=60))
    assert len(blocks) > 1
    assert sorted(r["k"] for b in blocks for r in b) == list(range(500))
