"""The pipeline: what each stage keeps, and what its decisions do to the result."""

import zlib

import corpus_pipeline


def test_planted_rows(spark):
    from talkatlas.runtime import shared_dir

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    first = docs.where("n_chars > 1500").orderBy("doc_id").first()
    item = items.orderBy("item_id").first()
    noise = "".join(chr(97 + zlib.crc32(str(i).encode()) % 26) + " " * (i % 7 == 0) for i in range(4000))
    passage = " ".join(f"passage{i}" for i in range(60))
    other = docs.where("n_chars BETWEEN 2000 AND 3000").orderBy("doc_id").take(2)
    planted = [
        (90_001, first["text"], "en", "src1", 1),
        (90_002, noise, "en", "src1", 1),
        (90_003, f"{first['text'][100:900]} {item['text']} tail", "en", "src1", 1),
        (90_004, f"{other[0]['text'][::-1]} {passage}", None, None, 1),
        (90_005, f"{passage} {other[1]['text'][::-1]}", None, None, 1),
        (90_006, None, "en", "src1", None),
    ]
    rows = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    folder = f"{shared_dir(spark)}/planted"
    items.write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")
    rows.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    at, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, folder)
        at.write.mode("overwrite").parquet(f"{folder}/{name}")
        at = spark.read.parquet(f"{folder}/{name}")
        seen[name] = {r["doc_id"]: r["text"] for r in at.collect()}
        if name != "source_mixing":
            assert at.columns == docs.columns
    assert not {90_002, 90_006} & set(seen["language_id"]) and 90_001 in seen["language_id"]
    assert len(seen["language_id"]) >= 0.95 * rows.count() - 10
    assert 90_001 not in seen["simhash_near_dedup"] and first["doc_id"] in seen["simhash_near_dedup"]
    for key in (90_004, 90_005):
        if key in seen["simhash_near_dedup"]:
            assert "passage30" in seen["simhash_near_dedup"][key] and "passage30" not in seen["substring_dedup"][key]
    assert 90_003 not in seen["benchmark_decontamination"]
    assert all(item["text"] not in t for t in seen["benchmark_decontamination"].values())
    assert set(seen["source_mixing"]) <= set(seen["benchmark_decontamination"])
    assert corpus_pipeline.run(spark, folder).count() == spark.read.parquet(f"{folder}/source_mixing").count()
