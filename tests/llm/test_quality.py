"""The quality classifier: held-out accuracy, its parts, special rows."""

import math
import random

import numpy as np
import pyarrow as pa

from talkatlas.llm import quality
from talkatlas.llm.columns import Powers


def tables(spark):
    draw = random.Random(3)
    word = lambda: "".join(draw.choice(["ba", "do", "ki", "lu"]) for _ in range(draw.randrange(1, 4)))
    rows, labels = [], []
    for i in range(300):
        good = draw.random() < 0.7
        rows.append((i, " ".join(word() if good else word().upper() + "!!" for _ in range(draw.randrange(5, 60)))))
        labels.append((i, int(good)))
    rows += [(900, None), (901, ""), (902, "BADO!! " * 50_000), (None, "ba do"), (7, rows[7][1])]
    labels += [(5, 1 - labels[5][1]), (8, None), (None, 1), (77_777, 0)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    return rows, docs, spark.createDataFrame(labels, "doc_id long, quality int"), dict(labels[:300])


def test_held_out_rows_are_told(spark):
    rows, docs, labels, truth = tables(spark)
    found = quality.scored(docs, labels).collect()
    assert len(found) == len(rows)
    again = quality.scored(docs.repartition(2), labels).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    held = [r for r in found if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[900]["score"] == by_id[901]["score"] and by_id[902]["predicted"] == 0 and not by_id[None]["held_out"]


def test_one_class_or_none(spark):
    _, docs, labels, _ = tables(spark)
    ones = quality.scored(docs, labels.where("quality = 1")).collect()
    assert len({r["score"] for r in ones}) == 1 and ones[0]["score"] > 0.9
    assert {r["score"] for r in quality.scored(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.scored(docs.limit(0), labels).collect() == []


def test_slots_are_indicators_per_row():
    slot, offsets = quality.slots(pa.array(["a b a b", "", None, "A!! a", "a b a b"]), Powers())
    rows = [slot[s:e].tolist() for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
    assert all(r == sorted(set(r)) for r in rows)
    assert rows[0] == rows[4] and rows[1] == rows[2] and set(rows[0]) != set(rows[3])


def test_margins_do_not_depend_on_neighbours():
    draw = np.random.default_rng(2)
    model = quality.QualityModel(draw.normal(size=16), draw.random(16), 1.0, 0.0)
    rows = [draw.integers(0, 16, n) for n in (5, 0, 3, 7, 0, 0)]
    together = model.margins(np.concatenate(rows), np.cumsum([0, *map(len, rows)]))
    alone = [model.margins(r, np.array([0, len(r)]))[0] for r in rows]
    assert np.allclose(together, alone) and together[1] == together[5] == 0


def test_descent_separates():
    draw = np.random.default_rng(1)
    rows = [np.unique(draw.integers(0, 20, 6)) for _ in range(80)]
    sign = np.array([1.0 if 3 in r else -1.0 for r in rows])
    weights = quality.coordinate_descent(rows, [np.ones(len(r)) for r in rows], sign, np.full(80, 10.0), 20)
    assert all(np.sign(weights[r].sum()) == s for r, s in zip(rows, sign, strict=True))


def indicators(seed, count=60, size=300):
    """Texts as sets of slots, with labels that depend on a few of them."""
    draw = random.Random(seed)
    rows = [np.array(sorted(draw.sample(range(size), draw.randrange(5, 25)))) for _ in range(count)]
    return rows, np.array([int(sum(s < 60 for s in r) * 5 + draw.random() > len(r)) for r in rows]), size


def test_ratios_equal_the_definition():
    rows, label, size = indicators(6)
    counts = [[quality.SMOOTHING + sum(s in r for r, y in zip(rows, label, strict=True) if y == side) for s in range(size)] for side in (0, 1)]
    plain = [math.log(counts[1][s] / sum(counts[1])) - math.log(counts[0][s] / sum(counts[0])) for s in range(size)]
    assert np.allclose(quality.log_ratios(rows, label, size), plain)


def test_descent_nears_the_optimum():
    """The dual variables, worked out from the weights, bound how far these are from the best."""
    rows, label, size = indicators(7)
    sign, cost = np.where(label == 1, 1.0, -1.0), np.full(len(rows), 0.7)
    ratio = quality.log_ratios(rows, label, size)
    values = [ratio[r] / np.linalg.norm(ratio[r]) for r in rows]
    weights = quality.coordinate_descent(rows, values, sign, cost, size)
    matrix = np.zeros((len(rows), size))
    for line, r, v, s in zip(matrix, rows, values, sign, strict=True):
        line[r] = s * v
    assert np.linalg.matrix_rank(matrix) == len(rows)
    dual = np.linalg.lstsq(matrix.T, weights, rcond=None)[0]
    assert np.allclose(matrix.T @ dual, weights) and (dual > -1e-9).all() and (dual < cost + 1e-9).all()
    primal = weights @ weights / 2 + (cost * np.maximum(1 - matrix @ weights, 0)).sum()
    gap = primal - (dual.sum() - weights @ weights / 2)
    assert -1e-9 <= gap <= 0.02 * primal


def test_scores_equal_the_definition():
    rows, label, size = indicators(8, 90)
    held = np.arange(90) % 5 == 0
    model = quality.fitted(rows, label, held, size)
    ratio = quality.log_ratios([r for r, h in zip(rows, held, strict=True) if not h], label[~held], size)
    assert np.allclose(model.squares, ratio**2) and set(label) == {0, 1}
    found = model.scores(np.concatenate(rows), np.cumsum([0, *map(len, rows)]))
    for r, score in zip(rows, found, strict=True):
        margin = sum(model.weights[s] for s in r) / math.sqrt(sum(ratio[s] ** 2 for s in r))
        assert math.isclose(score, 1 / (1 + math.exp(-(model.slope * margin + model.shift))), rel_tol=1e-9)
