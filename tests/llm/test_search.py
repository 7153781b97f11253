"""Ranked search against scoring every document."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from talkatlas.llm import search

DOCS = "doc_id long, text string, item string, score int"
ITEMS = "item_id long, text string, rank int"


def brute(docs, items, k=10):
    held = [(i, Counter(search.terms_of(t or ""))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    found = []
    for name, text in items:
        scores = []
        for i, c in held:
            m = 25 + 75 * sum(c.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in search.terms_of(text or "")
                if c[t]
            )
            if score > 0:
                scores.append((-score, i is None, i))
        found += [(name, n + 1, i, -s) for n, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(found, key=str)


def found(spark, docs, items, k=10, width=search.WIDTH):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], DOCS).repartition(3)
    items = spark.createDataFrame([(i, t, 9) for i, t in items], ITEMS)
    return sorted((tuple(r) for r in search.rank(docs, items, k, width).collect()), key=str)


def corpus(seed, n=300):
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdeé字0") for _ in range(draw.randrange(1, 6))) for _ in range(400)]
    text = lambda size: "".join(draw.choice(words[: draw.choice([20, 400])]).title() + draw.choice([" ", ", ", "\n"]) for _ in range(size))
    docs = [(i, text(draw.choice([1, 5, 40, 40, 900]))) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(n // 3)] + [(None, docs[4][1]), (None, None), (7, docs[7][1])]
    items = [(i, text(draw.choice([1, 8, 30]))) for i in range(25)] + [(100 + i, docs[i][1]) for i in range(6)]
    return docs, items


@pytest.mark.parametrize("width", [4, 64, search.WIDTH])
def test_equals_brute_force(spark, monkeypatch, width):
    docs, items = corpus(3)
    if width == 64:
        monkeypatch.setattr(search, "BLOCK_ITEMS", 7)
    assert found(spark, docs, items, 10, width) == brute(docs, items)


def test_edge_rows(spark):
    docs = [(1, None), (2, ""), (3, " .,-\n"), (4, "Äb ÄB äb"), (5, "ab_AB/ab"), (6, "zz " * 50_000), (5, "ab_AB/ab"), (None, "ab")]
    items = [(1, None), (2, "--"), (3, "AB ab"), (4, "äb"), (None, "zz"), (3, "AB ab"), (5, "none of these")]
    assert found(spark, docs, items) == brute(docs, items)
    # Only A to Z are lowered.
    assert [r[2] for r in found(spark, docs, [(9, "äb")])] == [4]
    assert found(spark, docs, []) == [] == found(spark, [], items) == found(spark, docs[:3], items)


def test_bounds_hold_and_few_are_scored():
    docs, items = corpus(8)
    texts = [t or "" for _, t in docs]
    asked = search.Items([(n, i, t) for n, (i, t) in enumerate(items)])
    counts = [Counter(search.terms_of(t)) for t in texts]
    n_docs, n_terms = sum(map(bool, counts)), sum(sum(c.values()) for c in counts)
    held = Counter(t for c in counts for t in c)
    asked.weigh({i: held[t.decode()] for i, t in enumerate(asked.vocabulary.to_pylist())}, n_docs)
    searcher = search.Searcher(asked, n_docs, n_terms, 10, search.WIDTH)
    part = pa.RecordBatch.from_arrays([pa.array([i for i, _ in docs], pa.int64()), pa.array(texts)], ["doc_id", "text"])
    terms = search.Terms(part.column("text"))
    spread = search.spreads(terms.count, n_docs, n_terms)
    bounds = searcher.bounds(terms, spread)
    item, row = np.indices(bounds.shape).reshape(2, -1)
    exact = searcher.exact(terms.known(asked.vocabulary), item, row, spread).reshape(bounds.shape)
    assert (bounds >= exact).all() and exact.any()
    searcher.see(part)
    assert searcher.scored < 0.5 * bounds.size
