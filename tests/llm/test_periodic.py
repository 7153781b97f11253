"""Periodic runs against comparing every word with every other."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from talkatlas.llm import periodic, queries


def brute(words):
    """All runs: for every period the maximal stretches, if no smaller period holds for them."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        start = 0
        while start < n - q:
            end = start
            while end < n - q and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            if length >= max(6, 4 * q):
                stretch = words[start : start + length]
                if not any(all(a == b for a, b in zip(stretch, stretch[p:], strict=False)) for p in range(1, q)):
                    found.append((start, length, q))
            start = max(end, start + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of(texts):
    codes, offsets = [], [0]
    for words in texts:
        known = {}
        codes += [known.setdefault(w, len(known)) for w in words]
        offsets.append(len(codes))
    found = periodic.runs(np.array(codes, np.int64), np.array(offsets))
    return [[tuple(r[1:]) for r in found.tolist() if r[0] == t] for t in range(len(texts))]


def test_transforms_are_exact():
    draw = np.random.default_rng(1)
    for prime, root in periodic.PRIMES:
        # The root is primitive as far as powers of two go.
        assert pow(root, (prime - 1) // 2, prime) == prime - 1
        for width in (2, 4, 64, 1024):
            x = draw.integers(0, prime, (3, width)).astype(np.uint64)
            assert np.array_equal(periodic.inverse(periodic.transform(x, prime, root), prime, root), x)


@pytest.mark.parametrize("size", [1, 2, 8, 32])
def test_occurrences_of_a_block(size):
    draw = np.random.default_rng(size)
    blocks = draw.integers(1, 3, (40, size)).astype(np.uint64)
    windows = draw.integers(0, 3, (40, 2 * size)).astype(np.uint64)
    windows[::2, size - 1 : 2 * size - 1] = blocks[::2]
    found = periodic.occurrences(blocks, windows)
    for row in range(40):
        expected = [bool((windows[row, k : k + size] == blocks[row]).all()) for k in range(size)]
        assert found[row].tolist() == expected


def test_large_symbols_need_more_primes():
    blocks = np.full((1, 4), 1 << 26, np.uint64)
    windows = np.full((1, 8), 1 << 26, np.uint64)
    windows[0, 5] = 1
    assert periodic.occurrences(blocks, windows).tolist() == [[True, True, False, False]]


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_runs_of_random_texts(letters):
    draw, texts = random.Random(letters), []
    for _ in range(60):
        words = [draw.randrange(letters) for _ in range(draw.randrange(0, 60))]
        for _ in range(draw.randrange(3)):
            stretch = [draw.randrange(letters) for _ in range(draw.randrange(1, 12))]
            words += (stretch * 9)[: draw.randrange(1, 9 * len(stretch))] + [draw.randrange(letters)]
        texts.append(words)
    assert runs_of(texts) == [brute(t) for t in texts]


def test_runs_within_runs():
    texts = [list("aaaaaaaab" * 6), list("ab" * 40 + "ab" * 3), list(("a" * 30 + "b") * 5), list("abcabcab" * 9 + "x" * 7)]
    assert runs_of(texts) == [brute(t) for t in texts]


def test_texts_next_to_each_other_share_nothing():
    assert runs_of([["a"] * 4, ["a"] * 4, [], ["a"] * 6]) == [[], [], [], [(0, 6, 1)]]


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_rows(spark):
    texts = [None, "", " \n", "a b", "x " * 50 + "end", "one two three " * 7 + "one", "a " * 5, "é ü " * 6, "é ü " * 6]
    long = " ".join(str(i % 5003) for i in range(40_000))
    rows = [(i, t, "en", 3) for i, t in enumerate([*texts, long])] + [(None, "b " * 8, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, length int").repartition(3)
    found = {r["doc_id"]: r for r in periodic.periodic_runs(docs).collect()}
    for name, text, _, _ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = brute(words) if len(words) < 1000 else [(0, 40_000, 5003)]
        row = found[name]
        assert row["n_words"] == len(words) and [tuple(r) for r in row["runs"]] == runs
        assert row["collapsed"] == collapsed(words, runs)
    assert periodic.periodic_runs(docs.limit(0)).collect() == []


def test_query(spark, tmp_path):
    draw = random.Random(4)
    rows = []
    for i in range(120):
        words = [f"w{draw.randrange(40)}" for _ in range(draw.choice([0, 1, 5, 30, 300]))]
        text = draw.choice([" ", "\n", "  "]).join(words) + draw.choice(["", " ", " na na na na na na na"])
        rows.append((i, None if i % 41 == 40 else text))
    rows.append((None, "x " * 9))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r.asDict() for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()}
    some = 0
    for name, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(name).encode()) if name is not None else 1
        g, n = h // 10, len(words)
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        some += bool(runs)
        assert found[name] == {
            "doc_id": name,
            "n_runs": len(runs),
            "start": best[0],
            "length": best[1],
            "period": best[2],
            "exponent_milli": 1000 * best[1] // best[2] if runs else None,
            "runs_sha256": hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(collapsed(words, runs).encode()).hexdigest(),
        }
    assert some > 20
