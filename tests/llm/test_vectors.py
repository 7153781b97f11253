"""Embedding near-duplicates against brute force."""

import numpy as np
import pytest

from talkatlas.llm import vectors


def brute(rows, least):
    ids = [r[0] for r in rows]
    usable = [
        r[2] is not None and r[1] is not None and len(r[1]) > 0 and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])
        for r in rows
    ]
    count, label = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if usable[i] and usable[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= least:
                    count[i] += 1
                    count[j] += 1
                    x, y = find(i), find(j)
                    label[max(x, y)] = min(x, y)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(ids[i])
    return sorted((ids[i], count[i], min(members[find(i)])) for i in range(len(rows)))


@pytest.mark.parametrize("block", [2000, 7])
def test_links_and_components(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    monkeypatch.setattr(vectors, "STEP_ROWS", 5)
    draw = np.random.default_rng(3)
    rows, centre = [], draw.normal(size=(6, 24))
    for i in range(150):
        x = centre[i % 6] + draw.normal(size=24) * draw.choice([0, 0.05, 0.1, 0.4])
        rows.append((i * 3, [float(v) for v in x.astype(np.float32)], int(i % 6 > 2)))
    rows += [(500, [1.0, 0.0, 0.0], 1), (501, [2.0, 0.0, 0.0], 1), (502, [1e30, 0.0], 1), (503, [3.0, 0.1], 1)]
    rows += [(600, None, 1), (601, [], 1), (602, [0.0] * 24, 1), (603, [float("nan")] + [1.0] * 23, 1)]
    rows += [(604, [None] + [1.0] * 23, 1), (605, rows[0][1], None), (606, rows[0][1], None), (607, [float("inf")] + [1.0] * 23, 1)]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<float>, label int, node int")
    found = vectors.near_duplicates(docs.repartition(3)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == brute(rows, 0.98)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)
    assert vectors.near_duplicates(docs.limit(0)).collect() == []
