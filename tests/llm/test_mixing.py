"""Targets, draws and the splitting tree."""

import json

import pytest

from talkatlas.llm import mixing


def corpus(spark, sizes, odd=True):
    rows = [(100 * s + i, "w " * (1 + (7 * i + s) % 50), None if s == 9 else f"s{s}") for s, n in sizes.items() for i in range(n)]
    if odd:
        rows += [(5000, None, "s1"), (5001, "", "s1"), (None, "a b c", "s1"), (None, "a b c d", None), (101, rows[1][1], "s1"),
                 (101, rows[1][1], "s1"), (5002, "long " * 30_000, "s2")]
    return rows, spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, source string, key string")


def targets(rows):
    size = {}
    for _, text, source in rows:
        size[source] = size.get(source, 0) + len((text or "").split())
    order = sorted((s for s in size if s is not None)) + [s for s in size if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(size.values()), set()
    while True:
        free = sum(w for s, w in weight.items() if s not in capped)
        level = (total - sum(2 * size[s] for s in capped)) / free if free else 0
        more = {s for s in size if s not in capped and 2 * size[s] <= level * weight[s]}
        if not more:
            return {s: float(2 * size[s]) if s in capped else level * weight[s] for s in size}
        capped |= more


def test_targets_and_draws(spark):
    rows, docs = corpus(spark, {1: 90, 2: 60, 3: 5, 9: 40, 4: 30})
    found = mixing.drawn(docs.repartition(4)).collect()
    assert len(found) == len(rows)
    wanted, name = targets(rows), {r[0]: r[2] for r in rows if r[0] is not None}
    taken = {}
    for r in found:
        source = name.get(r["doc_id"], "s1" if r["size"] == 3 else None)
        assert r["target"] == pytest.approx(wanted[source])
        assert len(r["draws"]) <= 2 and all(0 <= d["shard"] < 8 for d in r["draws"])
        taken[source] = taken.get(source, 0) + len(r["draws"]) * r["size"]
    for source, words in taken.items():
        assert abs(words - wanted[source]) <= (30_000 if source == "s2" else 60), source
    again = mixing.drawn(docs.repartition(7)).collect()
    key = lambda r: (str(r["doc_id"]), r["size"], str(r["draws"]))
    assert sorted(map(key, found)) == sorted(map(key, again))


def test_mix_has_a_row_per_draw(spark, tmp_path):
    _, docs = corpus(spark, {1: 20, 2: 20})
    mix = mixing.mixed(docs)
    assert mix.columns == [*docs.columns, "mix_copy", "mix_shard", "mix_order"]
    assert mix.count() == sum(len(r["draws"]) for r in mixing.drawn(docs).collect())
    mixing.write_shards(mix, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == mix.count()
    assert mixing.drawn(docs.limit(0)).collect() == []


def test_shards_grow_with_the_words(spark):
    """More shards for more words, each with about as many words, and the same draws."""
    rows = [(i, "w " * 50, "big" if i % 4 else f"s{i % 3}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    few = {r["doc_id"]: r for r in mixing.drawn(docs).collect()}
    many = {r["doc_id"]: r for r in mixing.drawn(docs, shard_words=20_000).collect()}
    shards = {}
    for doc_id, r in many.items():
        assert [d["copy"] for d in r["draws"]] == [d["copy"] for d in few[doc_id]["draws"]]
        for d in r["draws"]:
            shards[d["shard"]] = shards.get(d["shard"], 0) + r["size"]
    total = sum(shards.values())
    assert total == pytest.approx(450_000, rel=0.01)
    assert mixing.tree_levels(total, 20_000) == 5 and set(shards) == set(range(32))
    assert all(0.6 * total / 32 < words < 1.4 * total / 32 for words in shards.values())
    assert mixing.tree_levels(0) == mixing.tree_levels(1e6) == 3 and mixing.tree_levels(2e13) == 20


def test_blocks_ascend_with_the_key(spark):
    keys = spark.createDataFrame([("00000000ff",), ("0000ffff00",), ("7fffffffff",), ("80000000aa",), ("ffffffffff",)], "key string")
    block = mixing._block(keys["key"], mixing.F.lit(1_000_003).cast("long"))
    assert [r[0] for r in keys.sort("key").select(block).collect()] == [0, 15, 500_001, 500_001, 1_000_002]


def test_tree_keeps_quotas_and_fills_shards(spark):
    quotas = {"a": 103, "b": 7, None: 40, "c": 1}
    table = spark.createDataFrame(list(quotas.items()), "source string, quota long")
    leaves = [r.asDict() for r in mixing.split_quotas(table, 3, 1).collect()]
    for source, quota in quotas.items():
        assert sum(r["quota"] for r in leaves if r["source"] == source) == quota
    sums = [sum(r["quota"] for r in leaves if r["shard"] == s) for s in range(8)]
    assert sum(sums) == 151 and max(sums) - min(sums) <= 1
    assert len({json.dumps(sorted((str(r["source"]), r["quota"]) for r in leaves if r["shard"] == s)) for s in range(8)}) > 1


def test_halves_are_hypergeometric(spark):
    """The mean share of a source on the left is its share of the node."""
    table = spark.createDataFrame([("a", 12), ("b", 4)], "source string, quota long")
    left = [
        next(r["quota"] for r in mixing.split_quotas(table, 1, seed).collect() if r["shard"] == 0 and r["source"] == "a")
        for seed in range(12)
    ]
    assert 4 <= min(left) and max(left) <= 8 and 5 <= sum(left) / 12 <= 7
