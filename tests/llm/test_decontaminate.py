"""Benchmark items in documents, against plain edit distance."""

import random

from talkatlas.llm import decontaminate


def plain_distance(pattern, text):
    """The least edit distance of a pattern to any substring, by rows."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        last, row[0] = 0, 0
        for j in range(1, len(row)):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (pattern[j - 1] != c))
        best = min(best, row[-1])
    return best


def test_bit_parallel_distance():
    draw = random.Random(1)
    for _ in range(60):
        pattern = "".join(draw.choice("abc") for _ in range(draw.randrange(1, 90)))
        text = "".join(draw.choice("abc") for _ in range(draw.randrange(0, 120)))
        assert decontaminate.least_distance(decontaminate.masks(pattern), len(pattern), text) == plain_distance(pattern, text)


def edited(text, edits, draw):
    chars = list(text)
    for _ in range(edits):
        at = draw.randrange(len(chars))
        chars[at : at + draw.choice([0, 1, 1])] = draw.choice(["", "q", "zz"])[:1]
    return "".join(chars)


def test_items_are_found_up_to_the_error_rate(spark):
    draw = random.Random(2)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 8)))
    items = [(i, " ".join(word() for _ in range(20))) for i in range(8)]
    docs = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(30))]
        for _, text in draw.sample(items, draw.randrange(3)):
            parts.append(edited(text, draw.randrange(16), draw))
        docs.append((i, " \n".join(parts) + " " + word()))
    docs += [(100, None), (101, ""), (None, items[0][1].upper()), (102, "x " * 100_000 + items[1][1]), (103, items[2][1]), (103, items[2][1])]
    odd = [(50, None), (51, "short"), (0, items[0][1]), (60, " " + items[3][1] + "\n")]
    table = spark.createDataFrame([(*d, "h") for d in docs], "doc_id long, text string, hits string")
    bench = spark.createDataFrame(items + odd, "item_id long, text string")
    found = sorted(((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(table, bench).collect()), key=str)
    normal = lambda t: " ".join((t or "").lower().split())
    expected = []
    for d, text in docs:
        for i, item in [*items, (60, items[3][1])]:
            item, text = normal(item), normal(text)
            if (item in text) or (len(text) < 5000 and plain_distance(item, text) <= int(decontaminate.ERROR_RATE * len(item))):
                expected.append((d, i))
    assert found == sorted(expected, key=str)
    kept = decontaminate.without_items(table, bench)
    assert kept.columns == table.columns
    dirty = [d for d, _ in expected]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in dirty)
    assert decontaminate.contaminated(table.limit(0), bench).collect() == []
    assert decontaminate.without_items(table, bench.limit(0)).count() == len(docs)


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 60)
    bench = spark.createDataFrame([(i, f"this is the benchmark item number {i * 1111}") for i in range(6)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"so: This is  the benchmark item number {i * 1111}!") for i in range(6)], "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench, 0.0).collect()}
    assert found == {(i, i) for i in range(6)}
    assert decontaminate.without_items(docs, bench, 0.0).count() == 0


def test_short_items_between_word_boundaries(spark):
    items = [(1, "Short one"), (2, "é"), (3, ""), (4, " \n"), (5, None), (6, "= 12?")]
    docs = [(1, "a SHORT\n one."), (2, "shorts one, short ones"), (3, "short one"), (4, "Short  one (é)"), (5, "café"), (6, "x=12? x = 12?y"), (7, "x = 12"), (8, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["distance"]) for r in found) == [(1, 1, 0), (3, 1, 0), (4, 1, 0), (4, 2, 0), (6, 6, 0)]
