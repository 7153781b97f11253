import json
from functools import partial

import numpy as np
import pytest
from test_cluster import vector_table

from talkatlas.operators import cluster, hierarchy
from talkatlas.params import HierarchyParams
from talkatlas.runtime import row_blocks


def cosine_gaps(points):
    norms = np.linalg.norm(points, axis=1, keepdims=True)
    units = np.divide(points, norms, out=np.zeros_like(points), where=norms > 0)
    return 1 - units @ units.T


def merged_one_by_one(gaps, linkage, n_parents=None, threshold=None):
    """The plain method: merge the closest two groups until done."""
    groups = [[i] for i in range(len(gaps))]
    join = {"average": np.mean, "single": np.min, "complete": np.max}[linkage]
    while len(groups) > (n_parents or 1):
        best = min(
            (join(gaps[np.ix_(g, h)]), i, j)
            for i, g in enumerate(groups)
            for j, h in enumerate(groups)
            if i < j
        )
        if threshold is not None and best[0] >= threshold:
            break
        groups[best[1]] = groups[best[1]] + groups.pop(best[2])
    return sorted(sorted(g) for g in groups)


def point_table(spark, points):
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "cluster_id INT, centroid ARRAY<DOUBLE>").repartition(3)


@pytest.mark.parametrize(
    ("linkage", "options"),
    [
        ("average", {"n_parents": 4}),
        ("complete", {"n_parents": 6}),
        ("single", {"n_parents": 5}),
        ("average", {"distance_threshold": 0.7}),
        ("complete", {"distance_threshold": 0.8}),
    ],
)
def test_groups_agree_with_merging_one_by_one(spark, linkage, options):
    points = np.random.default_rng(len(linkage)).normal(size=(25, 4))
    points[3] = 0
    params = HierarchyParams(linkage=linkage, **options)
    rows = hierarchy.group_clusters(point_table(spark, points), params).collect()
    groups = {}
    for row in rows:
        groups.setdefault(row["parent_id"], []).append(row["cluster_id"])
    found = [sorted(groups[p]) for p in sorted(groups)]
    expected = merged_one_by_one(
        cosine_gaps(points), linkage, options.get("n_parents"), options.get("distance_threshold")
    )
    assert found == expected
    assert sorted(groups) == list(range(len(groups)))


def grouped(spark, points, **options):
    rows = hierarchy.group_clusters(point_table(spark, points), HierarchyParams(**options)).collect()
    groups = {}
    for row in rows:
        groups.setdefault(row["parent_id"], []).append(row["cluster_id"])
    return [sorted(groups[p]) for p in sorted(groups)]


def test_complete_linkage_of_larger_groups(spark, monkeypatch):
    monkeypatch.setattr(hierarchy, "GROUP_BLOCK", 13)
    draw = np.random.default_rng(7)
    # Groups of more members than bound them, some of them spread out, with copies and zero vectors.
    centre = draw.normal(size=(6, 5)) * 3
    points = centre[draw.integers(6, size=60)] + draw.normal(size=(60, 5)) * draw.choice([0.1, 1.0], size=(60, 1))
    points[50:55] = points[50]
    points[[7, 8]] = 0
    gaps = cosine_gaps(points).round(12).clip(0, 2)
    assert grouped(spark, points, linkage="complete", n_parents=4) == merged_one_by_one(gaps, "complete", 4)


def test_bounds_hold(spark):
    points = np.random.default_rng(9).normal(size=(40, 3))
    points[5] = 0
    units = [p / np.linalg.norm(p) if p.any() else p for p in points]
    state = spark.createDataFrame([(i % 7, u.tolist(), 0.5) for i, u in enumerate(np.array(units))], "label INT, total ARRAY<DOUBLE>, height DOUBLE")
    table = hierarchy._summaries(state).toArrow().combine_chunks().to_batches()[0]
    bounds = hierarchy._Bounds.of(table)
    least, most = bounds.against(bounds)
    gaps = cosine_gaps(points)
    for i, a in enumerate(bounds.labels):
        for j, b in enumerate(bounds.labels):
            true = gaps[np.ix_(np.arange(40) % 7 == a, np.arange(40) % 7 == b)].max()
            assert a == b or least[i, j] <= true <= most[i, j]


def test_divisive_tree_of_many_clusters(spark):
    draw = np.random.default_rng(1)
    # Directions that part in two, three times over.
    centre = np.array([[4 * a, 2 * b, c, 0] for a in (1, -1) for b in (1, -1) for c in (1, -1)])
    label = draw.integers(8, size=20_000)
    points = centre[label] + draw.normal(size=(20_000, 4)) * 0.1
    points[17] = 0
    found = grouped(spark, points, linkage="divisive", n_parents=8)
    assert sorted(map(len, found)) and sum(map(len, found)) == 20_000 and len(found) == 8
    # Every true group is whole, but for the zero vector.
    assert {frozenset(g) - {17} for g in found} == {frozenset(np.flatnonzero(label == c).tolist()) - {17} for c in range(8)}
    assert 17 in found[0] and found[0][0] == 0


def test_divisive_tree_of_few_clusters(spark):
    assert grouped(spark, np.eye(3), linkage="divisive", n_parents=1) == [[0, 1, 2]]
    assert grouped(spark, np.zeros((2, 3)), linkage="divisive", n_parents=2) == [[0, 1]]
    assert grouped(spark, np.eye(2), linkage="divisive", n_parents=9) == [[0], [1]]
    with pytest.raises(ValueError, match="divisive"):
        HierarchyParams(linkage="divisive", distance_threshold=0.5)


def test_edges_of_grouping(spark):
    points = point_table(spark, np.eye(4))
    assert {r["parent_id"] for r in hierarchy.group_clusters(points).collect()} == {0}
    # Orthogonal centroids are at distance 1 exactly, which is not below 1.
    apart = hierarchy.group_clusters(points, HierarchyParams(distance_threshold=1.0))
    assert sorted(r["parent_id"] for r in apart.collect()) == [0, 1, 2, 3]
    more = hierarchy.group_clusters(points, HierarchyParams(n_parents=9))
    assert sorted(r["parent_id"] for r in more.collect()) == [0, 1, 2, 3]
    single = hierarchy.group_clusters(points.where("cluster_id = 2"), HierarchyParams(n_parents=3))
    assert [tuple(r) for r in single.collect()] == [(2, 0)]
    for wrong in ({"linkage": "ward"}, {"n_parents": 0}, {"n_parents": 2, "distance_threshold": 0.5}):
        with pytest.raises(ValueError):
            HierarchyParams(**wrong)


@pytest.mark.parametrize("block_rows", [4096, 3])
def test_distances(spark, block_rows, monkeypatch):
    monkeypatch.setattr(cluster, "row_blocks", partial(row_blocks, block_rows=block_rows))
    points = np.random.default_rng(2).normal(size=(9, 3))
    points[4] = 0
    found = {(r["a"], r["b"]): r["distance"] for r in hierarchy.centroid_distances(point_table(spark, points)).collect()}
    assert sorted(found) == [(a, b) for a in range(9) for b in range(a + 1, 9)]
    gaps = cosine_gaps(points)
    assert all(abs(gap - gaps[pair]) < 1e-12 for pair, gap in found.items())


def test_document(spark):
    df = vector_table(spark, np.eye(3, dtype=np.float32), [2, 0, 1])
    row = json.loads(hierarchy.build_hierarchy(df).toJSON().first())
    assert row["parents"] == [
        {"parent_id": 0, "child_cluster_ids": [0, 1, 2], "parent_summary": "", "parent_name": ""}
    ]
    assert row["meta"]["n_clusters"] == 3 and row["meta"]["n_parents"] == 1
    assert row["meta"]["params"]["linkage"] == "average" and row["meta"]["params"]["random_state"] == 42
    empty = hierarchy.build_hierarchy(df.where("false")).first()
    assert (empty["meta"]["n_clusters"], empty["parents"]) == (0, [])
