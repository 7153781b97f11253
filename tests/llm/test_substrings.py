"""Removal of recurring word windows and repeated byte strings, against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from talkatlas.llm import passages, substrings, suffixes
from talkatlas.llm.columns import Powers
from talkatlas.llm.fm_index import FMIndex, WaveletTree
from talkatlas.llm.passages import split

WORDS = re.compile("[^\x20\x09-\x0d]+")


def texts(seed, count):
    """Texts over few words, with shared passages, loops, copies and odd white space."""
    draw = random.Random(seed)
    vocabulary = ["a", "b", "äö", "c d", "日本", "e,", "F"]

    def words(n):
        return [draw.choice(vocabulary) for _ in range(n)]

    shared = [words(draw.randrange(4, 30)) for _ in range(6)]
    found = []
    for _ in range(count):
        parts = [words(draw.randrange(12)) if draw.random() < 0.5 else draw.choice(shared) for _ in range(draw.randrange(6))]
        found.append(draw.choice([" ", "\n", " \t "]).join(w for p in parts for w in p))
    return found + [found[0], "", " \n", None, "a " * 200, "x" * 300, "only once in the whole table"]


def brute_words(rows, window):
    lists = [WORDS.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in lists for i in range(len(w) - window + 1))
    out = []
    for (key, _), w in zip(rows, lists, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((key, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def brute_bytes(rows, window):
    seen, out = set(), []
    for key, text in sorted(rows, key=lambda r: r[0]):
        data, gone = (text or "").encode(), set()
        for i in range(len(data) - window + 1):
            piece = data[i : i + window]
            if piece in seen:
                gone.update(range(i, i + window))
            seen.add(piece)
        spans = sum(i - 1 not in gone for i in gone)
        out.append((key, len(data), len(gone), spans, bytes(c for i, c in enumerate(data) if i not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("full", [2000, 2])
def test_recurring_words(spark, monkeypatch, full):
    monkeypatch.setattr(substrings, "ANCHOR_PASSAGES", full)
    monkeypatch.setattr(substrings, "SHARD_WORDS", 60)
    rows = list(enumerate(texts(1, 40)))
    table = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, tag int").repartition(3)
    found = substrings.remove_recurring(table, window=7, gram=3).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute_words(rows, 7)


def test_recurring_words_in_special_rows(spark):
    text = " ".join(f"w{i}" for i in range(12))
    other = " ".join(f"v{i}" for i in range(12))
    rows = [(1, text, "x"), (1, text, "x"), (2, other, None), (None, other, "y"), (None, None, "y"), (3, "w0 w1", "z")]
    table = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    found = substrings.replace_texts(table, window=7, gram=3)
    assert found.columns == table.columns
    assert sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=str) == sorted(
        [(1, ""), (1, ""), (2, ""), (None, ""), (None, ""), (3, "w0 w1")], key=str
    )
    assert substrings.remove_recurring(table.limit(0), window=7, gram=3).collect() == []


@pytest.mark.parametrize("full", [2000, 2])
def test_repeated_bytes(spark, monkeypatch, full):
    monkeypatch.setattr(suffixes, "ANCHOR_PASSAGES", full)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 300)
    rows = list(enumerate(texts(2, 40)))
    table = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, place int").repartition(3)
    found = suffixes.remove_repeated(table, window=20, gram=6).collect()
    assert sorted(((*r[:4], bytes(r[4])) for r in found), key=str) == brute_bytes(rows, 20)


def test_repeated_bytes_in_special_rows(spark):
    text = "".join(f"w{i} " for i in range(30))
    rows = [(5, text), (5, text), (7, text), (None, text), (None, None), (8, "short")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffixes.remove_repeated(table, window=20, gram=6)
    assert sorted(((r["doc_id"], r["n_removed"]) for r in found.collect()), key=str) == sorted(
        [(5, 0), (5, 0), (7, len(text)), (None, len(text)), (None, 0), (8, 0)], key=str
    )
    assert suffixes.remove_repeated(table.limit(0), window=20, gram=6).collect() == []


@pytest.mark.parametrize("full", [2000, 2])
def test_rows_stored_twice_beside_similar_texts(spark, monkeypatch, full):
    monkeypatch.setattr(suffixes, "ANCHOR_PASSAGES", full)
    monkeypatch.setattr(substrings, "ANCHOR_PASSAGES", full)
    draw = random.Random(6)
    letters = lambda n: "".join(draw.choice("abcdefgh  ") for _ in range(n))
    base = [letters(400) for _ in range(6)]
    rows = []
    for i, text in enumerate(base):
        rows += [(10 * i + 1, text)] * 2
        for j, shared in enumerate((60, 100, 140, 400)):
            at = draw.randrange(401 - shared)
            rows.append((10 * i + 2 + j, letters(150) + text[at : at + shared] + letters(150)))
    found = suffixes.remove_repeated(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    # A row that is stored twice is one document.
    expected = {r[0]: r for r in brute_bytes(sorted(set(rows)), 100)}
    assert sorted((*r[:4], bytes(r[4])) for r in found.collect()) == sorted(expected[i] for i, _ in rows)
    words = [(i, " ".join(t)) for i, t in rows]
    found = substrings.remove_recurring(spark.createDataFrame(words, "doc_id long, text string"), window=35)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_words(words, 35)


def test_many_equal_rows_without_an_id(spark):
    text = " ".join(f"w{i}" for i in range(90))
    rows = spark.range(5000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    found = passages.recurring(passages.occurrences(rows, substrings._words, 35, 8))
    # As many entries as the text has passages, however often it is stored.
    assert found.count() < 60 and found.where("m <> 5000").isEmpty()
    assert substrings.remove_recurring(rows).where("n_words = 90 AND n_removed = 90").count() == 5000
    assert suffixes.remove_repeated(rows).where("n_removed = 0").count() == 5000


def test_every_window_lies_in_one_passage():
    draw = np.random.default_rng(4)
    codes = draw.integers(1, 5, 400).astype(np.uint64)
    offsets = np.array([0, 0, 3, 120, 130, 400])
    row, start, offset, count, anchor, _ = split(codes, offsets, 9, 4, Powers())
    windows = [(r, s + i) for r, s, n in zip(row, start, count, strict=True) for i in range(n)]
    sizes = np.diff(offsets)
    assert sorted(windows) == [(r, i) for r in range(5) for i in range(max(sizes[r] - 8, 0))]
    assert ((offset >= count - 1) & (offset <= 5)).all()
    by_content = {}
    for r, s, n, a in zip(row, start, count, anchor, strict=True):
        for i in range(n):
            at = offsets[r] + s + i
            assert by_content.setdefault(tuple(codes[at : at + 9]), a) == a


def test_wavelet_tree_counts():
    draw = np.random.default_rng(5)
    values = draw.integers(0, 11, 300)
    tree = WaveletTree(values, 4)
    for symbol in range(11):
        at = np.arange(301)
        start, end = (tree.descend(np.full(301, symbol), x) for x in (np.zeros(301, np.int64), at))
        assert (end - start == [(values[:i] == symbol).sum() for i in at]).all()


def test_index_counts_weighted_windows():
    draw = np.random.default_rng(6)
    lengths = np.array([6, 9, 5, 12, 30])
    symbols = draw.integers(1, 3, lengths.sum())
    weights = np.array([1, 1, 3, 1, 1])
    flags = FMIndex(symbols, lengths, weights, 5).recurring(symbols, lengths)
    seen, ends = Counter(), np.cumsum(lengths)
    for end, n, w in zip(ends, lengths, weights, strict=True):
        for i in range(end - n, end - 4):
            seen[tuple(symbols[i : i + 5])] += w
    for end, n in zip(ends, lengths, strict=True):
        for i in range(end - n, end):
            assert flags[i] == (i + 5 <= end and seen[tuple(symbols[i : i + 5])] >= 2)
