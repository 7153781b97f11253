"""Rows without an id, or of one id, keep their own passages apart from those of other rows."""

from talkatlas.llm import substrings, suffixes


def test_many_rows_without_an_id(spark):
    # 3,000 such rows agree in 16 bits of a text hash in about 70 pairs.
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(None if i % 2 else 7, " ".join(f"u{i}x{j}" for j in range(60)), False) for i in range(3000)]
    rows += [(None if i % 2 else 7, f"{passage} only{i} {i}", True) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shared boolean").repartition(3)
    kept = {r["text"] for r in substrings.replace_texts(docs).collect()}
    assert kept == {t for _, t, shared in rows if not shared} | {t[len(passage) + 1 :] for _, t, shared in rows if shared}
    clean = {t for _, t, shared in rows if not shared}
    found = suffixes.remove_repeated(docs).where("n_removed > 0").collect()
    assert len(found) == 1499 and not {bytes(r["kept"]).decode() for r in found} & clean
    assert all(r["n_bytes"] - r["n_removed"] < 100 for r in found)
