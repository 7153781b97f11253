"""MaxScore against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkatlas.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, shard int"


def brute(rows, every, k):
    whole = {
        (i, tuple(math.floor(256 * float(x)) for x in v))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    found = []
    for i, v in whole:
        if i % every == 0:
            scores = [(-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in whole if (j, w) != (i, v)]
            found += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(found)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 7) for i, v in rows], SCHEMA)


def asked(df, every, k=5):
    found = topk.top_products(df, F.col("vec_id") % every == 0, k)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("kind", ["clustered", "spread", "falling"])
def test_equals_brute_force(spark, monkeypatch, kind):
    for name, value in (("START_ROWS", 20), ("FEW_ROWS", 8), ("RAISE_ROWS", 10), ("CUT_TERMS", 3), ("SHARD_VALUES", 2400)):
        monkeypatch.setattr(topk, name, value)
    draw = np.random.default_rng(5)
    centre = draw.normal(size=(7, 24))
    x = centre[draw.integers(0, 7, 700)] + draw.normal(size=(700, 24)) * (0.1 if kind == "clustered" else 2.0)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "falling":
        # No product is above zero, so no threshold is.
        x = np.abs(x) * np.where(np.arange(700) % 5 == 0, 1, -1)[:, None]
    rows = [(int(i), [float(v) for v in row.astype(np.float32)]) for i, row in enumerate(x)]
    # A third of all rows are one vector, so that scores tie.
    rows += [(1000 + i, rows[3][1]) for i in range(350)]
    assert asked(table(spark, rows).repartition(5), 5) == brute(rows, 5, 5)


def test_terms_before_the_split_are_only_probed():
    draw = np.random.default_rng(2)
    rows = draw.integers(-9, 10, (400, 12))
    rows[:, 0] *= 200
    shard = topk.Shard(np.arange(400), np.zeros(400, np.int64), rows)
    weight = draw.integers(1, 9, 12)
    at = shard._competitive(weight, -1, 5)
    # One strong term decides, and most rows are never scored.
    assert len(at) < 80
    scores = rows @ weight
    assert set(np.lexsort((np.arange(400), -scores))[:5]) <= set(at)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (5, [1.0, 0.0]), (10, None), (15, [None, 1.0]), (20, [nan, 1.0]), (25, [1.0, inf])]
    rows += [(None, [1.0, 0.0]), (30, []), (35, [0.5]), (40, [-1.0, 0.5, 3.0]), (45, [0.0, 0.0]), (0, [1.0, 0.0]), (5, [0.5, 0.5])]
    found = asked(table(spark, rows), 5)
    assert found == brute(rows, 5, 5)
    # A query has no partner in its own row, however often that is stored.
    assert (0, 1, 5, 65536) in found and not any(q == v == 0 for q, _, v, _ in found)
    assert topk.top_products(table(spark, rows).limit(0), F.col("vec_id") % 5 == 0).collect() == []
    assert asked(table(spark, rows[:1]), 5) == []
