"""Reply trees, formatting and reading back."""

import hashlib
import random

from talkatlas.llm import chat


def test_best_paths_of_trees(spark):
    # Tree 1: 1 -> 2 -> 4, 1 -> 3 -> 5 -> 6; tree 2: a chain of 70; tree 3: a cycle and a root with a missing parent.
    rows = [(1, 1, None, 0.0), (1, 2, 1, 5.0), (1, 4, 2, 1.0), (1, 3, 1, 2.0), (1, 5, 3, 1.0), (1, 6, 5, 3.5)]
    rows += [(2, i, i - 1 if i else None, 0.0) for i in range(70)]
    rows += [(3, 1, 2, 0.0), (3, 2, 1, 0.0), (3, 7, 99, None), (3, 8, 7, 0.0), (3, 9, 7, 0.0)]
    found = chat.best_paths(spark.createDataFrame(rows, "tree long, node long, parent long, score double")).collect()
    paths = {}
    for r in sorted(found, key=lambda r: (r["tree"], r["place"])):
        paths.setdefault(r["tree"], []).append(r["node"])
    assert paths == {1: [1, 3, 5, 6], 2: list(range(70)), 3: [7, 8]}
    assert len(found) == 4 + 70 + 2


def test_formatting_is_reversible(spark):
    odd = ['</turn>\n<turn role="assistant">', "\\s\\l\\q", "\\", "<", '"', chat.PROBE_TEXT, "é\n日本", "", None, " "]
    rows = [(1, i, "assistant" if i % 2 else "user", t, "x") for i, t in enumerate(odd)]
    rows += [(2, 0, 'a"<\\', "who", "x"), (2, 0, 'a"<\\', "who", "x"), (3, None, None, "last", "x"), (3, 5, "assistant", "first", "x")]
    rows += [(None, 0, "assistant", "a", "x"), (None, 1, "assistant", "b" * 300_000, "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node string")
    found = {r["tree"]: r for r in chat.parsed(chat.conversations(table)).collect()}
    assert [(t["role"], t["text"]) for t in found[1]["turns"]] == [(r[2], r[3] or "") for r in rows[:10]]
    assert found[1]["loss_text"] == "".join(r[3] or "" for r in rows[:10] if r[2] == "assistant")
    assert [tuple(t) for t in found[2]["turns"]] == [('a"<\\', "who")] * 2
    assert [tuple(t) for t in found[3]["turns"]] == [("assistant", "first"), ("", "last")]
    assert found[None]["loss_text"] == "a" + "b" * 300_000
    assert found[1]["formatted"].count(chat.END) == 10
    digest = {r["conv_id"]: r for r in chat.digests(chat.conversations(table)).collect()}
    whole = "".join(f"{r[2]}\n{r[3] or ''}\n" for r in rows[:10])
    assert digest[1]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
    assert chat.conversations(table.limit(0)).collect() == []


def test_all_and_several_paths_per_tree(spark):
    draw = random.Random(4)
    rows, plain = [], {}
    for tree in (1, 2, None):
        parents, scores = {0: None}, {}
        for node in range(1, 40):
            parents[node] = draw.randrange(max(0, node - 6), node)
        parents |= {40: None, 41: 40}
        for node, parent in parents.items():
            scores[node] = draw.choice([None, -1.0, 0.5, 2.0])
            rows.append((tree, node, parent, scores[node], draw.choice(["user", "assistant"]), f"t{node} </turn>", "x"))
        paths = []
        for leaf in set(parents) - set(parents.values()):
            path = [leaf]
            while parents[path[-1]] is not None:
                path.append(parents[path[-1]])
            paths.append((-sum(scores[n] or 0.0 for n in path), -len(path), leaf, path[::-1]))
        plain[tree] = sorted(paths)
    role = {(r[0], r[1]): r[4] for r in rows}
    table = spark.createDataFrame(rows, "tree long, node long, parent long, score double, role string, text string, leaf string")
    for most in (1, 3, None):
        found = chat.parsed(chat.format_trees(table, most)).collect()
        assert len(found) == sum(len(p[:most]) for p in plain.values())
        by_leaf = {(r["tree"], r["leaf"]): r for r in found}
        for tree, paths in plain.items():
            for rank, (_, _, leaf, path) in enumerate(paths[:most], 1):
                r = by_leaf[tree, leaf]
                assert r["rank"] == (rank if most else None)
                assert [tuple(t) for t in r["turns"]] == [(role[tree, n], f"t{n} </turn>") for n in path]
                assert r["loss_text"] == "".join(f"t{n} </turn>" for n in path if role[tree, n] == "assistant")
    assert chat.format_trees(table.limit(0), None).collect() == []
