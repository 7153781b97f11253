import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_cluster import vector_table

from talkatlas.functions import vectors
from talkatlas.operators import neighbors
from talkatlas.operators.neighbors import approximate_neighbors, nearest_neighbors, recall


def brute_force(values, k, metric):
    values = values.astype(float)
    if metric == "cosine":
        norms = np.linalg.norm(values, axis=1, keepdims=True)
        units = np.divide(values, norms, out=np.zeros_like(values), where=norms > 0)
        gaps = 1 - units @ units.T
    else:
        gaps = np.linalg.norm(values[:, None] - values[None], axis=2)
    gaps = gaps.round(9)
    ids = np.arange(len(values))
    found = {}
    for i in ids:
        others = ids[ids != i]
        order = others[np.lexsort((others, gaps[i, others]))][:k]
        found[i] = [(j, gaps[i, j]) for j in order]
    return found


def clumped():
    """Dense groups, a third of the rows copies of one vector, two zero vectors."""
    rng = np.random.default_rng(11)
    centers = rng.normal(size=(8, 6)) * 4
    values = centers[rng.integers(8, size=240)] + rng.normal(size=(240, 6)) * 0.1
    values[60:140] = values[60]
    values[[5, 200]] = 0
    return values.astype(np.float32)


@pytest.mark.parametrize(("metric", "block_rows"), [("cosine", 2048), ("cosine", 12), ("euclidean", 12)])
def test_agrees_with_comparing_everything(spark, metric, block_rows, monkeypatch):
    # Low enough for the copies to count as frequent.
    monkeypatch.setattr(neighbors, "MIN_HOT_COPIES", 10)
    values = clumped()
    df = vector_table(spark, values).drop("cluster_id")
    rows = nearest_neighbors(df, 4, metric, block_rows=block_rows).orderBy("id", "rank").collect()
    found = {}
    for row in rows:
        found.setdefault(row["id"], []).append((row["neighbor_id"], round(row["distance"], 6)))
    expected = brute_force(values, 4, metric)
    assert found == {i: [(j, round(g, 6)) for j, g in near] for i, near in expected.items()}


def test_fewer_rows_than_neighbours(spark):
    df = vector_table(spark, np.array([[1, 0], [0, 1], [1, 1]], dtype=np.float32)).drop("cluster_id")
    rows = nearest_neighbors(df.withColumn("id", F.concat(F.lit("r"), "id")), 10).orderBy("id", "rank").collect()
    assert [(r["id"], r["neighbor_id"]) for r in rows] == [
        ("r0", "r2"), ("r0", "r1"), ("r1", "r2"), ("r1", "r0"), ("r2", "r0"), ("r2", "r1")
    ]
    assert nearest_neighbors(df.where("false"), 3).count() == 0


@pytest.mark.parametrize("block_rows", [2048, 9])
def test_approximate_neighbours_of_dense_groups(spark, block_rows, monkeypatch):
    monkeypatch.setattr(neighbors, "MIN_HOT_COPIES", 10)
    values = clumped()
    df = vector_table(spark, values).drop("cluster_id")
    found = approximate_neighbors(df, 4, tables=8, bucket_length=0.5, block_rows=block_rows).cache()
    exact = nearest_neighbors(df, 4).cache()
    assert recall(found, exact).first()["recall"] >= 0.9
    # What is found has its true distance; copies and zero vectors are as in the exact search.
    gaps = {i: dict(brute_force(values, 239, "cosine")[i]) for i in (0, 5, 70)}
    for row in found.where(F.col("id").isin(0, 5, 70)).collect():
        assert row["distance"] == pytest.approx(gaps[row["id"]][row["neighbor_id"]], abs=1e-6)
    copies = (F.col("id") == 70) | (F.col("id") == 5)
    assert sorted(map(tuple, found.where(copies).collect())) == sorted(map(tuple, exact.where(copies).collect()))


def test_one_wide_bucket_is_exact(spark):
    values = clumped()
    df = vector_table(spark, values).drop("cluster_id")
    found = approximate_neighbors(df, 5, "euclidean", tables=1, projections=1, bucket_length=1e6, block_rows=50)
    exact = nearest_neighbors(df, 5, "euclidean")
    rounded = lambda rows: sorted((r["id"], r["rank"], r["neighbor_id"], round(r["distance"], 9)) for r in rows.collect())
    # A bucket border at zero may still part the rows, but not for all of them.
    assert recall(found, exact).first()["recall"] >= 0.5
    assert len(rounded(found)) <= len(rounded(exact))


def test_approximate_neighbours_of_few_rows(spark):
    df = vector_table(spark, np.array([[1, 0], [0, 1], [0, 0]], dtype=np.float32)).drop("cluster_id")
    rows = approximate_neighbors(df, 3, bucket_length=1e-6).orderBy("id", "rank").collect()
    # The first two never meet; a zero vector is at distance 1 from everything.
    assert [tuple(r) for r in rows] == [(0, 2, 1.0, 1), (1, 2, 1.0, 1), (2, 0, 1.0, 1), (2, 1, 1.0, 2)]
    assert approximate_neighbors(df.where("false"), 3).count() == 0


@pytest.mark.parametrize("width", [6, 1])
def test_nearest_rows_over_many_blocks(width, monkeypatch):
    for name, value in (("SCREEN_QUERIES", 7), ("SCREEN_ROWS", 50), ("SCREEN_RUN", 2)):
        monkeypatch.setattr(vectors, name, value)
    rng = np.random.default_rng(5)
    rows = rng.integers(-3, 4, size=(333, width)).astype(float)
    queries = np.vstack([rows[:40], rng.normal(size=(20, width))])
    for k in (1, 4, 11, 400):
        gaps = np.array([vectors.exact_distance(rows, q) for q in queries])
        expected = [(i, j, gaps[i, j]) for i in range(len(queries)) for j in np.lexsort((np.arange(333), gaps[i]))[:k]]
        assert list(zip(*vectors.nearest_rows(queries, rows, k), strict=True)) == expected


def test_rows_travel_once_per_group_and_not_once_per_cell(spark, monkeypatch):
    # Without structure no bound rules out anything, and 75 cells want every row.
    values = np.random.default_rng(3).normal(size=(600, 12)).astype(np.float32)
    df = vector_table(spark, values).drop("cluster_id")
    sides = []
    compare = neighbors._best_of_blocks

    def spy(distinct, left, right, *rest):
        sides.append((left.count(), right.count()))
        return compare(distinct, left, right, *rest)

    monkeypatch.setattr(neighbors, "_best_of_blocks", spy)
    rows = nearest_neighbors(df, 4, block_rows=8).orderBy("id", "rank").collect()
    assert sides[0][0] == 600 and sides[0][1] <= neighbors.MIN_GROUPS * 600
    expected = brute_force(values, 4, "cosine")
    assert [(r["id"], r["neighbor_id"]) for r in rows] == [(i, j) for i in expected for j, _ in expected[i]]
    # Smaller blocks on both sides give the same rows.
    monkeypatch.setattr(neighbors, "BLOCK_COMPONENTS", 12 * 30)
    assert nearest_neighbors(df, 4, block_rows=8).orderBy("id", "rank").collect() == rows
    assert sides[1][0] > 600


def test_wide_buckets_are_compared_once(spark, monkeypatch):
    values = clumped()
    df = vector_table(spark, values).drop("cluster_id")
    wheres = []
    compare = neighbors._best_of_blocks

    def spy(distinct, left, right, where, *rest):
        wheres.append(where)
        return compare(distinct, left, right, where, *rest)

    monkeypatch.setattr(neighbors, "_best_of_blocks", spy)
    search = lambda: sorted(map(tuple, approximate_neighbors(df, 4, tables=8, projections=1, bucket_length=0.9, block_rows=50).collect()))
    once = search()
    # The same by buckets: then no table counts as held by them.
    monkeypatch.setattr(neighbors, "MOST_BUCKET_PAIRS", 1e9)
    assert search() == once
    assert wheres == [["qb", "rb"], ["bucket", "qb", "rb"]]


def test_sharing_rows_are_found_however_few(spark):
    rng = np.random.default_rng(8)
    rows = rng.normal(size=(200, 5))
    keys = rng.integers(0, 40, size=(200, 3))
    table = pa.table({"keys": keys.tolist()})
    found = neighbors._nearest_sharing(table, table, rows, rows, 6)
    got = {}
    for q, r, gap in zip(*found, strict=True):
        got.setdefault(q, []).append((r, gap))
    for q in range(200):
        near = np.flatnonzero((keys == keys[q]).any(axis=1))
        gaps = vectors.exact_distance(rows[near], rows[q])
        assert got[q] == [(near[i], gaps[i]) for i in np.argsort(gaps, kind="stable")[:6]]
