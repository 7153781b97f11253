"""Language models: Kneser-Ney sums, held-out accuracy, rejection, special rows."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from talkatlas.llm import language

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "er", "ein"], "cc": ["eau", "oi", "que", "é"]}


def text(name, draw):
    return " ".join("".join(draw.choice(SYLLABLES[name]) for _ in range(draw.randrange(1, 5))) for _ in range(draw.randrange(3, 40)))


def table(spark, count=400):
    draw = random.Random(1)
    rows = [(i, text(name, draw), name) for i, name in ((i, draw.choice(list(SYLLABLES))) for i in range(count))]
    noise = "".join(draw.choice("qxzwvjyQXZ ") for _ in range(3000))
    rows += [(1000, None, "aa"), (1001, " 12 !? ½", "bb"), (1002, rows[0][1].upper(), None), (None, rows[0][1], "cc"),
             (1003, noise, None), (1004, rows[0][1], rows[0][2]), (1004, rows[0][1], rows[0][2])]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, row string")


def test_held_out_rows_are_told(spark):
    rows, docs = table(spark)
    found = language.identify(spark, docs).collect()
    assert len(found) == len(rows)
    truth = {r[0]: r[2] for r in rows[:400]}
    held = [r for r in found if r["doc_id"] in truth and r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert sum(r["rejected"] for r in found if r["doc_id"] in truth) <= 4
    by_id = {r["doc_id"]: r for r in found}
    for i in (1000, 1001):
        assert (by_id[i]["lang_pred"], by_id[i]["score"], by_id[i]["rejected"]) == ("und", 0.0, True)
    assert by_id[1002]["lang_pred"] == rows[0][2] and by_id[None]["held_out"] is False
    assert by_id[1003]["rejected"] and all(0 <= r["score"] <= 1 for r in found)
    kept = language.keep_known(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - sum(r["rejected"] for r in found)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "aa")], "doc_id long, text string, lang string")
    assert {(r["doc_id"], r["lang_pred"]) for r in language.identify(spark, docs).collect()} == {(1, "und"), (2, "und")}
    assert language.identify(spark, docs.limit(0)).collect() == []


def test_probabilities_sum_to_one():
    words = ["abca", "bcab", "cc", "abab", "acb"]
    grams, _ = language.word_grams(words, 3)
    known, counts = np.unique(grams, axis=0, return_counts=True)
    model = language._Counts(known, counts.astype(float), 5)
    symbols = np.unique(grams)
    symbols = symbols[symbols != 0]
    for context in {tuple(g[:-1]) for g in grams}:
        rows = np.array([[*context, s] for s in symbols])
        # Four symbols are known; the fifth of the alphabet stands for all others.
        unseen = model.probability(np.array([[*context, 999]]))
        assert abs(model.probability(rows).sum() + unseen[0] - 1) < 1e-9


def plain_model(words, order, alphabet):
    """Interpolated Kneser-Ney from its definition, with dictionaries: log-probability of a word."""
    padded = lambda w: [*"\x00" * (order - 1), *w, "\x01"]
    counts = {order: Counter()}
    for p in map(padded, words):
        counts[order].update(tuple(p[i - order + 1 : i + 1]) for i in range(order - 1, len(p)))
    for size in range(order - 1, 0, -1):
        counts[size] = Counter(g[1:] for g in counts[size + 1])
    discount, total, types = {}, defaultdict(int), defaultdict(int)
    for size, table in counts.items():
        ones, twos = (sum(n == k for n in table.values()) for k in (1, 2))
        discount[size] = ones / (ones + 2 * twos) if ones else 0.1
        for gram, n in table.items():
            total[gram[:-1]] += n
            types[gram[:-1]] += 1

    def probability(gram):
        if not gram:
            return 1 / alphabet
        size, context, lower = len(gram), gram[:-1], probability(gram[1:])
        if context not in total:
            return lower
        kept = max(counts[size][gram] - discount[size], 0)
        return (kept + discount[size] * types[context] * lower) / total[context]

    def score(word):
        p = padded(word)
        return sum(math.log(probability(tuple(p[i - order + 1 : i + 1]))) for i in range(order - 1, len(p)))

    return score


def test_scores_equal_the_definition(spark):
    """Share, choice and scores of every text, held-out and unseen symbols included."""
    rows, docs = table(spark, 150)
    fold = lambda i: zlib.crc32(str(i).encode()) % 3
    learnt = {name: [w for i, t, lang in rows if lang == name and i is not None and fold(i) == 0 for w in language.words_of(t or "")] for name in SYLLABLES}
    alphabet = len({c for words in learnt.values() for w in words for c in w}) + 2
    plain = {name: plain_model(words, language.ORDER, alphabet) for name, words in learnt.items()}
    found = {r["doc_id"]: r for r in language.identify(spark, docs).collect()}
    for i, t, _ in rows:
        words = language.words_of(t or "")
        if words and i is not None:
            sums = {name: sum(map(score, words)) for name, score in plain.items()}
            best = max(sums, key=sums.get)
            share = 1 / sum(math.exp(s - sums[best]) for s in sums.values())
            assert found[i]["lang_pred"] == best
            assert found[i]["score"] == pytest.approx(share, abs=1e-3)
    model, = language.fit(docs)
    words = sorted({w for _, t, _ in rows for w in language.words_of(t or "")})
    scores = model.word_scores(words)
    for name, column in zip(model.languages, scores.T, strict=True):
        assert column.tolist() == pytest.approx([plain[name](w) for w in words], rel=1e-4)


def test_blocks_of_languages_give_the_same(spark):
    rows, docs = table(spark, 150)
    ids = docs.selectExpr("struct(doc_id) AS row", "text")
    one, single = language.fit(docs), language.fit(docs, block_languages=1)
    whole, parts = (language.predict(ids, m).select("row.doc_id", "lang_pred", "score", "rejected") for m in (one, single))
    key = lambda r: (str(r["doc_id"]), r["lang_pred"], round(r["score"], 6), r["rejected"])
    assert sorted(map(key, whole.collect())) == sorted(map(key, parts.collect()))
    assert len(list(language.fit(docs, block_entries=500))) > 1
