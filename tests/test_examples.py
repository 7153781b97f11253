from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_cluster import vector_table

from talkatlas.operators import cluster, examples
from talkatlas.params import NamingParams
from talkatlas.runtime import row_blocks


def hot_values():
    """One cluster with most rows, a third of all rows being copies of one vector."""
    values = np.random.default_rng(5).normal(size=(300, 4)).astype(np.float32)
    values[100:200] = values[100]
    labels = [0] * 220 + [1] * 50 + [2] * 30
    return values, np.array(labels)


def brute_force(values, labels, n, outside=True):
    found = {}
    for c in np.unique(labels):
        center = values[labels == c].astype(float).mean(axis=0)
        gaps = np.linalg.norm(values.astype(float) - center, axis=1).round(9)
        ids = np.flatnonzero(labels != c if outside else labels == c)
        order = np.lexsort((ids, gaps[ids] if outside else -gaps[ids]))
        found[int(c)] = ids[order][:n].tolist()
    return found


def as_lists(df):
    found = {}
    for row in df.orderBy("cluster_id", "rank").collect():
        found.setdefault(row["cluster_id"], []).append(row["id"])
    return found


@pytest.mark.parametrize(("parts", "block_rows", "batch"), [(1, 4096, 10_000), (9, 4096, 7), (4, 1, 10_000)])
def test_nearest_outside_and_farthest_inside(spark, parts, block_rows, batch, monkeypatch):
    monkeypatch.setattr(cluster, "row_blocks", partial(row_blocks, block_rows=block_rows))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    values, labels = hot_values()
    df = vector_table(spark, values, labels, parts)
    points = cluster.centroids(df)
    assert as_lists(examples.nearest_outside(df, points, 15)) == brute_force(values, labels, 15)
    assert as_lists(examples.farthest_inside(df, points, 15)) == brute_force(values, labels, 15, False)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_text_ids(spark):
    values, labels = hot_values()
    df = vector_table(spark, values, labels).withColumn("id", F.format_string("r%03d", "id"))
    found = as_lists(examples.nearest_outside(df, cluster.centroids(df), 60))
    expected = brute_force(values, labels, 60)
    assert found == {c: [f"r{i:03d}" for i in ids] for c, ids in expected.items()}


def test_fewer_rows_than_asked_for(spark):
    values, labels = hot_values()
    df = vector_table(spark, values, labels)
    found = as_lists(examples.nearest_outside(df, cluster.centroids(df), 250))
    assert {c: len(ids) for c, ids in found.items()} == {0: 80, 1: 250, 2: 250}


def test_sample_does_not_depend_on_partitions(spark):
    values, labels = hot_values()
    one = as_lists(examples.sample_in_cluster(vector_table(spark, values, labels, 1), 40))
    many = as_lists(examples.sample_in_cluster(vector_table(spark, values, labels, 11), 40))
    other = as_lists(examples.sample_in_cluster(vector_table(spark, values, labels, 1), 40, seed=43))
    assert one == many and one != other
    assert {c: len(set(ids)) for c, ids in one.items()} == {0: 40, 1: 40, 2: 30}
    assert all(labels[i] == c for c, ids in one.items() for i in ids)


def test_bundles(spark):
    values, labels = hot_values()
    df = vector_table(spark, values, labels).withColumn("request", F.concat(F.lit("t"), "id"))
    params = NamingParams(in_cluster_n=5, out_cluster_n=3)
    rows = {r["cluster_id"]: r for r in examples.example_bundles(df, params, cluster_ids=[1, 9]).collect()}
    assert rows[1]["out_ids"] == brute_force(values, labels, 3)[1]
    assert rows[1]["out_texts"] == [f"t{i}" for i in rows[1]["out_ids"]]
    assert (rows[1]["in_sample_size"], rows[1]["out_sample_size"]) == (5, 3)
    assert (rows[9]["in_ids"], rows[9]["out_texts"], rows[9]["in_sample_size"]) == ([], [], 0)
    every = examples.example_bundles(df, params).orderBy("cluster_id").collect()
    assert [r["cluster_id"] for r in every] == [0, 1, 2]
    assert every[1]["in_ids"] == rows[1]["in_ids"]


def test_single_cluster_has_nothing_outside(spark):
    values, _ = hot_values()
    df = vector_table(spark, values).withColumn("request", F.lit("x"))
    row = examples.example_bundles(df).first()
    assert (row["in_sample_size"], row["out_sample_size"], row["out_ids"]) == (50, 0, [])


def test_many_centroids_in_one_scan(spark):
    values, labels = hot_values()
    df = vector_table(spark, values, labels)
    centers = np.random.default_rng(8).normal(size=(10_000, 4))
    points = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centers)], "cluster_id INT, centroid ARRAY<DOUBLE>")
    found = examples.nearest_outside(df, points, 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    lists = as_lists(found)
    assert len(lists) == 10_000
    for c in (0, 1, 2, 3, 5000, 9999):
        gaps = np.linalg.norm(values.astype(float) - centers[c], axis=1).round(9)
        ids = np.flatnonzero(labels != c)
        assert lists[c] == ids[np.lexsort((ids, gaps[ids]))][:3].tolist()
