import numpy as np
import pytest
from pyspark.sql import functions as F
from test_cluster import vector_table

from talkatlas.operators import project
from talkatlas.params import ProjectionParams


@pytest.fixture
def values():
    rng = np.random.default_rng(4)
    return (rng.normal(size=(200, 6)) * [3, 2, 1, 0.5, 0.2, 0.1] + 1).astype(np.float32)


def principal(values):
    _, vectors = np.linalg.eigh(np.cov(values.T))
    axes = vectors[:, ::-1][:, :2]
    return axes * np.sign(axes[np.abs(axes).argmax(axis=0), range(2)])


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_coordinates(spark, values, metric):
    df = vector_table(spark, values)
    rows = project.project_and_merge(df, ProjectionParams(metric=metric)).collect()
    space = values.astype(float)
    if metric == "cosine":
        space = space / np.linalg.norm(space, axis=1, keepdims=True)
    expected = space @ principal(space)
    assert len(rows) == 200 and rows[0]["cluster_id"] == 0
    for row in rows:
        np.testing.assert_allclose([row["x"], row["y"]], expected[row["id"]], atol=1e-8)


def test_needs_two_rows(spark, values):
    with pytest.raises(ValueError, match="two rows"):
        project.project(vector_table(spark, values[:1]))


def test_cache_is_used_only_for_the_same_content_and_parameters(spark, values, tmp_path, monkeypatch):
    calls = []
    original = project.project
    monkeypatch.setattr(project, "project", lambda *a: calls.append(1) or original(*a))
    params, folder = ProjectionParams(), str(tmp_path)
    df = vector_table(spark, values)
    first = project.cached_projection(df, params, folder).orderBy("id").collect()
    again = project.cached_projection(df.repartition(2), params, folder).orderBy("id").collect()
    assert first == again and len(calls) == 1
    values[7] = 0
    project.cached_projection(vector_table(spark, values), params, folder)
    project.cached_projection(df, ProjectionParams(n_neighbors=5), folder)
    assert len(calls) == 3


def test_two_writers_of_one_entry(spark, values, tmp_path, monkeypatch):
    original, folder, calls = project.project, str(tmp_path), []
    df = vector_table(spark, values)

    def slow(*a):
        calls.append(1)
        if len(calls) == 1:
            # Another writer begins and ends before this one.
            project.cached_projection(df, ProjectionParams(), folder).count()
        return original(*a)

    monkeypatch.setattr(project, "project", slow)
    found = project.cached_projection(df, ProjectionParams(), folder)
    assert len(calls) == 2 and found.count() == 200
    # One entry, and nothing of the writer that came second.
    assert len([p for p in tmp_path.iterdir() if not p.name.endswith(".crc")]) == 1


def test_bins(spark):
    df = spark.createDataFrame([(0, 0.05, -0.05), (0, 0.09, -0.01), (1, 0.05, 0.31)], "cluster_id INT, x DOUBLE, y DOUBLE")
    rows = project.projection_bins(df, 0.1).orderBy("cluster_id").collect()
    assert [tuple(r) for r in rows] == [(0, 0, -1, 2), (1, 0, 3, 1)]
    with pytest.raises(ValueError, match="missing columns: x, y"):
        project.projection_bins(df.select("cluster_id"), 0.1)


@pytest.mark.parametrize("block_rows", [4096, 2])
def test_silhouette(spark, values, block_rows, monkeypatch):
    blocks = project.row_blocks
    monkeypatch.setattr(project, "row_blocks", lambda df, key: blocks(df, key, block_rows=block_rows))
    values[3] = 0
    labels = np.array([i % 3 for i in range(199)] + [7])
    space = values.astype(float)
    norms = np.linalg.norm(space, axis=1, keepdims=True)
    units = np.divide(space, norms, out=np.zeros_like(space), where=norms > 0)
    gaps = 1 - units @ units.T
    expected = {}
    for i in range(200):
        means = {c: gaps[i, (labels == c) & (np.arange(200) != i)] for c in (0, 1, 2, 7)}
        own, score = means.pop(labels[i]), 0.0
        if len(own):
            other = min(m.mean() for m in means.values())
            score = (other - own.mean()) / max(other, own.mean())
        expected.setdefault(labels[i], []).append(score)
    rows = project.silhouette(vector_table(spark, values, labels)).collect()
    assert {r["cluster_id"]: r["n"] for r in rows} == {c: len(s) for c, s in expected.items()}
    for row in rows:
        assert row["silhouette"] == pytest.approx(np.mean(expected[row["cluster_id"]]), abs=1e-9)


def test_silhouette_of_a_single_cluster(spark, values):
    row = project.silhouette(vector_table(spark, values)).first()
    assert (row["n"], row["silhouette"]) == (200, 0.0)
    assert project.silhouette(vector_table(spark, values).where(F.lit(False))).count() == 0
