import os
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkatlas import runtime
from talkatlas.operators import complete as completion
from talkatlas.operators import facets
from talkatlas.operators.complete import complete, complete_logged, read_answers
from talkatlas.operators.embed import embed, fit_idf_encoder, hashing_encoder
from talkatlas.plans.stubs import stub_facet_completer


def upper_or_fail():
    def call(prompt):
        if "bad" in prompt:
            raise ValueError("no")
        return prompt.upper()

    return call


def test_failed_calls_leave_other_rows_alone(spark):
    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, "c")], "id INT, prompt STRING")
    for max_tasks, in_flight in ((None, 1), (2, 4)):
        rows = complete(df, "prompt", upper_or_fail, max_tasks, in_flight).orderBy("id").collect()
        assert [tuple(r) for r in rows] == [(1, "A", None), (2, None, "ValueError: no"), (3, "C", None)]


def test_several_prompts_per_row(spark):
    df = spark.sql("SELECT 1 AS id, array('a', 'bad') AS prompts")
    row = complete(df, "prompts", upper_or_fail).first()
    assert (row["raw"], row["error"]) == (["A", None], [None, "ValueError: no"])
    with pytest.raises(ValueError, match="missing columns: nothing"):
        complete(df, "nothing", upper_or_fail)


def conversations(spark):
    turns = '  <turn role="user">Hi und so\nweiter</turn>\n  <turn role="assistant">Yes</turn>'
    return spark.createDataFrame([("a", turns), ("b", "")], "id STRING, conversation_xml STRING")


def test_both_modes_give_the_same_facets(spark):
    df = conversations(spark)
    batched = facets.extract_facets(df, stub_facet_completer)
    single = facets.extract_facets_one_by_one(df, stub_facet_completer)
    assert batched.columns == single.columns == ["id", "request", "language", "task", "concerning"]
    expected = sorted(batched.collect())
    assert expected == sorted(single.collect())
    assert expected[0]["request"].endswith("Hi und so\nweiter") and expected[0]["language"] == "German"
    assert expected[1]["request"] == ""


def test_facets_of_failed_calls_are_empty(spark):
    def broken():
        def call(prompt):
            raise RuntimeError("down")

        return call

    rows = facets.extract_facets(conversations(spark), broken, keep_error=True).collect()
    assert all(r["request"] == r["concerning"] == "" and r["error"] == "RuntimeError: down" for r in rows)


def test_prompts_hold_conversation_and_tags(spark):
    df = spark.sql("SELECT 'THE TEXT' AS x")
    batched = df.select(facets.batched_prompt(F.col("x"))).first()[0]
    places = [batched.index(f"<{k}>") for k in facets.FACET_KEYS]
    assert "THE TEXT" in batched and places == sorted(places)
    for spec in facets.FACET_SPECS:
        prompt = df.select(facets.facet_prompt(F.col("x"), spec)).first()[0]
        assert prompt.count(spec.question) == 2 and "<answer>" in prompt
        assert ("<examples>" in prompt) == spec.with_examples


def test_embedding_of_missing_text(spark):
    df = spark.createDataFrame([("a", "one two two"), ("b", None), ("c", "")], "id STRING, request STRING")
    rows = {r["id"]: r["embedding"] for r in embed(df, hashing_encoder(16)).collect()}
    assert rows["b"] == rows["c"] == [0.0] * 16
    assert sum(x * x for x in rows["a"]) == pytest.approx(1)


def test_narrow_stages_accept_a_stream(spark, tmp_path):
    conversations(spark).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id STRING, conversation_xml STRING").parquet(str(tmp_path / "in"))
    found = embed(facets.extract_facets(stream, stub_facet_completer), hashing_encoder(8))
    query = (
        found.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    assert query.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_a_run_goes_on_where_one_before_failed(spark, tmp_path):
    calls, broken, log = tmp_path / "calls", tmp_path / "broken", str(tmp_path / "log")
    calls.write_text("")

    def completer():
        def call(prompt):
            if prompt == "p7" and not broken.exists():
                broken.write_text("")
                os._exit(1)  # The whole worker is lost, not only the call.
            with calls.open("a") as out:
                out.write(prompt + "\n")
            return prompt.upper()

        return call

    df = spark.createDataFrame([(i, f"p{i % 20}") for i in range(40)] + [(99, None)], "id INT, prompt STRING")
    with pytest.raises(Exception, match="(?i)crash|exited|abort"):
        complete_logged(df, "prompt", completer, log, max_tasks=1, slice_prompts=1)
    before = read_answers(spark, log).count()
    assert 0 < before < 20
    rows = {r["id"]: (r["raw"], r["error"]) for r in complete_logged(df, "prompt", completer, log, max_tasks=1, slice_prompts=1).collect()}
    assert rows == {i: (f"P{i % 20}", None) for i in range(40)} | {99: (None, None)}
    asked = Counter(calls.read_text().split())
    # Only what shared the slice with the lost call was asked twice.
    assert set(asked) == {f"p{i}" for i in range(20)} and asked.total() <= 24
    assert sum(n == 1 for n in asked.values()) >= before
    complete_logged(df, "prompt", completer, log).collect()
    assert Counter(calls.read_text().split()) == asked


def test_slices_of_one_job_stay_when_another_is_lost(spark, tmp_path):
    calls, log = tmp_path / "calls", tmp_path / "log"
    calls.write_text("")

    def completer():
        def call(prompt):
            if prompt == "lost" and not (tmp_path / "mended").exists():
                end = time.monotonic() + 20
                while len(list(log.glob("*.parquet"))) < 9 and time.monotonic() < end:
                    time.sleep(0.1)
                os._exit(1)
            with calls.open("a") as out:
                out.write(prompt + "\n")
            return prompt.upper()

        return call

    df = spark.createDataFrame([(f"p{i}",) for i in range(23)] + [("lost",)], "prompt STRING")
    with pytest.raises(Exception, match="(?i)crash|exited|abort"):
        complete_logged(df, "prompt", completer, str(log), slice_prompts=1)
    kept = {r["raw"].lower() for r in read_answers(spark, str(log)).collect()}
    # More than a task for each core, all of one job, which is named in its files.
    assert len(kept) >= 9 and len({f.name[11:47] for f in log.glob("*.parquet")}) == 1
    (tmp_path / "mended").write_text("")
    rows = complete_logged(df, "prompt", completer, str(log), slice_prompts=1).collect()
    assert sorted(r["raw"] for r in rows) == sorted([f"P{i}" for i in range(23)] + ["LOST"])
    asked = Counter(calls.read_text().split())
    assert len(asked) == 24 and all(asked[p] == 1 for p in kept)


def test_more_slices_than_a_job_holds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(completion, "JOB_SLICES", 10)
    monkeypatch.setattr(runtime, "SMALL_ROWS", 3)
    monkeypatch.setattr(runtime, "HOT_ROWS", 5)
    lists = [[f"p{i}", f"q{i % 7}"] for i in range(24)] + [["p0", "q0"]] * 30 + [[None], [], None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "id INT, prompts ARRAY<STRING>")
    found = complete_logged(df, "prompts", lambda: str.upper, str(tmp_path / "log"), slice_prompts=1)
    rows = {r["id"]: r["raw"] for r in found.collect()}
    assert rows == {i: [p and p.upper() for p in x or []] for i, x in enumerate(lists)}
    # Four jobs for 31 different prompts.
    assert len({f.name[11:47] for f in (tmp_path / "log").glob("*.parquet")}) == 4
    assert read_answers(spark, str(tmp_path / "log")).count() == 31
    flat = df.select("id", F.explode_outer("prompts").alias("prompt"))
    again = complete_logged(flat, "prompt", upper_or_fail, str(tmp_path / "log")).collect()
    asked = [(i, p) for i, x in enumerate(lists) for p in x or [None]]
    assert sorted((r["id"], r["raw"] or "") for r in again) == sorted((i, (p or "").upper()) for i, p in asked)


def test_few_slices_a_job_where_a_failed_job_leaves_nothing(spark):
    name = "spark.sql.parquet.output.committer.class"
    before = spark.conf.get(name)
    assert completion._job_slices(spark) == completion.JOB_SLICES
    spark.conf.set(name, "org.apache.hadoop.mapreduce.lib.output.FileOutputCommitter")
    try:
        assert completion._job_slices(spark) == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set(name, before)


def test_failed_calls_are_asked_again(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "bad"), (2, "bad")], "id INT, prompt STRING")
    first = complete_logged(df, "prompt", upper_or_fail, str(tmp_path / "log"), slice_prompts=2).collect()
    assert sorted(map(tuple, first)) == [(1, "A", None)] + [(2, None, "ValueError: no")] * 2
    again = complete_logged(df, "prompt", lambda: str.title, str(tmp_path / "log")).collect()
    assert sorted(map(tuple, again)) == [(1, "A", None), (2, "Bad", None), (2, "Bad", None)]
    assert complete_logged(df.limit(0), "prompt", upper_or_fail, str(tmp_path / "none")).collect() == []


def test_arrays_of_prompts_are_logged_one_by_one(spark, tmp_path):
    calls, log = tmp_path / "calls", str(tmp_path / "log")
    calls.write_text("")

    def completer():
        def call(prompt):
            if prompt == "bad" and not (tmp_path / "mended").exists():
                raise ValueError("no")
            with calls.open("a") as out:
                out.write(prompt + "\n")
            return prompt.upper()

        return call

    rows = [(1, ["a", "bad", "a"]), (1, ["a", "bad", "a"]), (2, ["b", None]), (3, []), (4, None), (5, ["bad"]), (6, [None])]
    df = spark.createDataFrame(rows, "id INT, prompts ARRAY<STRING>")
    failed = "ValueError: no"
    first = [(r["id"], r["raw"], r["error"]) for r in complete_logged(df, "prompts", completer, log, slice_prompts=1).collect()]
    a = (1, ["A", None, "A"], [None, failed, None])
    assert sorted(first) == [a, a, (2, ["B", None], [None, None]), (3, [], []), (4, [], []), (5, [None], [failed]), (6, [None], [None])]
    assert sorted(calls.read_text().split()) == ["a", "b"]
    (tmp_path / "mended").write_text("")
    again = {r["id"]: r["raw"] for r in complete_logged(df, "prompts", completer, log).collect()}
    assert again == {1: ["A", "BAD", "A"], 2: ["B", None], 3: [], 4: [], 5: ["BAD"], 6: [None]}
    # Only the call that had failed was made in the second run.
    assert sorted(calls.read_text().split()) == ["a", "b", "bad"]


def test_four_calls_a_row_go_on_from_the_log(spark, tmp_path):
    df, log = conversations(spark), str(tmp_path / "log")
    plain = sorted(facets.extract_facets_one_by_one(df, stub_facet_completer, keep_error=True).collect(), key=lambda r: r["id"])
    facets.extract_facets_one_by_one(df.where("id = 'a'"), stub_facet_completer, log_path=log)
    assert read_answers(spark, log).count() == 4
    logged = facets.extract_facets_one_by_one(df, stub_facet_completer, keep_error=True, log_path=log)
    assert sorted(logged.collect(), key=lambda r: r["id"]) == plain
    assert read_answers(spark, log).count() == 8


def test_rare_tokens_weigh_more(spark):
    rows = [("a", "the cat"), ("b", "the dog the"), ("c", None), ("d", "the"), ("e", "")]
    df = spark.createDataFrame(rows, "id STRING, request STRING")
    encode = fit_idf_encoder(df, 4096)
    found = encode(df)
    assert found.columns == ["id", "request", "embedding"]
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    vectors = {r["id"]: np.array(r["embedding"]) for r in found.collect()}
    the, cat = np.log(6 / 4), np.log(6 / 2)
    assert sorted(vectors["a"])[-2:] == pytest.approx([the / np.hypot(the, cat), cat / np.hypot(the, cat)], abs=1e-6)
    assert sorted(vectors["b"])[-2:] == pytest.approx([2 * the / np.hypot(2 * the, cat), cat / np.hypot(2 * the, cat)][::1 if 2 * the < cat else -1], abs=1e-6)
    assert not vectors["c"].any() and not vectors["e"].any() and len(vectors["c"]) == 4096
    # Other rows can be encoded with what was fitted, unknown tokens included.
    other = encode(spark.createDataFrame([("the zebra",)], "request STRING")).first()["embedding"]
    assert sum(x > 0 for x in other) == 2 and sum(x * x for x in other) == pytest.approx(1, abs=1e-6)
