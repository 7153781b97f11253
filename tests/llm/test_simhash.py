"""SimHash near-duplicates against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from talkatlas.llm import simhash
from talkatlas.llm.components import star_components


def roots(count, pairs):
    label = list(range(count))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return [find(i) for i in range(count)]


def brute_roots(prints):
    values = np.array(prints, np.uint64)
    pairs = [
        (i, j) for i in range(len(prints)) for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= 3) + i + 1
    ]
    return roots(len(prints), pairs)


def clustered(seed, count):
    """Fingerprints around a few centres, at distances of up to six bits."""
    draw = random.Random(seed)
    centres = [draw.getrandbits(64) for _ in range(count // 8)] + [0, 2**64 - 1]
    found = set()
    while len(found) < count:
        value = draw.choice(centres)
        for bit in draw.sample(range(64), draw.randrange(7)):
            value ^= 1 << bit
        found.add(value)
    return sorted(found)


@pytest.mark.parametrize("full", [2000, 3])
def test_links_connect_what_is_within_three_bits(spark, monkeypatch, full):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", full)
    prints = clustered(1, 400)
    signed = [v - 2**64 if v >= 2**63 else v for v in prints]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    place = {v: i for i, v in enumerate(signed)}
    linked = [(place[r["a"]], place[r["b"]]) for r in found]
    values = np.array(prints, np.uint64)
    assert roots(400, linked) == brute_roots(prints)
    assert all(np.bitwise_count(values[a] ^ values[b]) <= 64 for a, b in linked)


def plain_fingerprint(text):
    """Bit by bit, from the definition."""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text.translate({c: c + 32 for c in range(65, 91)})) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_survivors_against_brute_force(spark):
    draw = random.Random(9)
    base = [" ".join(draw.choice(["Ab", "cé", "D", "e\u00a0f", "GH", "ij,"]) + str(draw.randrange(30)) for _ in range(120)) for _ in range(20)]
    texts = base + [draw.choice(base) + draw.choice(["", " x", "  "]) for _ in range(60)] + ["", " ", "A b", "ÄÖ Q", "a\x1cb \x0bC"]
    rows = [(draw.randrange(10**6), t) for t in texts]
    prints = [plain_fingerprint(t) for t in texts]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r["doc_id"], r["fingerprint"]) for r in found) == sorted((i, f"{p:016x}") for (i, _), p in zip(rows, prints, strict=True))
    groups = {}
    for (i, _), root in zip(rows, brute_roots(prints), strict=True):
        groups.setdefault(root, []).append(i)
    least = {i: min(g) for g in groups.values() for i in g}
    assert {r["doc_id"]: r["component_id"] for r in found} == least
    kept = simhash.keep_first(spark.createDataFrame([(i, "x", t) for i, t in rows], "doc_id long, key string, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(least.values()))


def test_rows_without_an_id_and_of_one_id(spark):
    words = [" ".join(f"{a}{i}" for i in range(50)) for a in "abc"]
    rows = [(None, words[0], i) for i in range(2000)] + [(7, words[1], 0), (7, words[1], 1), (7, words[2], 2)]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(5)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == [(0, words[0]), (7, words[1]), (7, words[2])]


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 150)] + [(200, 201), (201, 200), (7, 7)]
    found = star_components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == (
        {i: 0 for i in range(61)} | {i: 100 for i in range(100, 150)} | {200: 200, 201: 200}
    )
    assert star_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_special_rows(spark):
    long_text = "word " * 50_000
    rows = [(5, None, "x"), (3, "", "x"), (9, " \t\n", "x"), (1, "One two three four", "x"), (8, "one TWO three\nfour", None),
            (8, "one TWO three\nfour", None), (4, "one two", "y"), (None, "one two", "y"), (None, "unlike any other here", "z"), (2, long_text, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    seen = {(r["doc_id"], r["component_id"]) for r in found}
    assert {(5, 3), (3, 3), (9, 3), (1, 1), (8, 1), (4, 4), (None, 4), (2, 2), (None, None)} == seen
    assert {r["fingerprint"] for r in found if r["doc_id"] in (3, 5, 9)} == {"0" * 16}
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    # A row without an id stays only where its group has no other.
    assert sorted((r["doc_id"] or 0, r["text"] and r["text"][:5]) for r in kept.collect()) == [
        (0, "unlik"), (1, "One t"), (2, "word "), (3, ""), (4, "one t")
    ]
    assert simhash.keep_first(docs.limit(0)).collect() == []
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
