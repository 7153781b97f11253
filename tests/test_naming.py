import numpy as np
from pyspark.sql import functions as F
from test_cluster import vector_table

from talkatlas.operators import naming
from talkatlas.params import NamingParams

REQUEST = "The user's overall request for the assistant is to "


def statements(spark, texts, cluster_id=0):
    rows = [(cluster_id, i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "cluster_id INT, rank INT, text STRING")


def test_equal_counts_go_to_the_first_token(spark):
    texts = [REQUEST + "help fix it.", REQUEST + "help fix that.", REQUEST + "outline a day."]
    found = naming.top_tokens(statements(spark, texts).repartition(3)).orderBy("rank").collect()
    assert [(r["token"], r["count"]) for r in found] == [
        ("user's", 3), ("overall", 3), ("request", 3), ("assistant", 3), ("help", 2), ("fix", 2)
    ]


def test_fallback_texts(spark):
    # The count puts one word in front; the rest is in reading order.
    texts = [REQUEST + "draft a concise summary.", REQUEST + "ask an assistant.", "concise summary"]
    row = naming.fallback_names(statements(spark, texts)).first()
    assert row["name"] == "Summarize Assistant User's Overall Request"
    assert row["summary"] == (
        "Participants requested or discussed topics matching a coherent theme. "
        "This cluster differed from nearby groups by emphasizing: "
        "assistant, user's, overall, request, concise, summary"
    )


def test_fallback_without_tokens_and_with_long_ones(spark):
    both = statements(spark, ["a 12 the", None, ""], 1).unionByName(statements(spark, ["x" * 30 + " " + "y" * 60], 2))
    rows = {r["cluster_id"]: r for r in naming.fallback_names(both).collect()}
    assert rows[1]["name"] == "Summarize" and rows[1]["summary"].endswith("emphasizing: ")
    assert len(rows[2]["name"]) == 80 and rows[2]["name"].startswith("Summarize Xxx")


def clustered(spark):
    values = np.random.default_rng(1).normal(size=(60, 3)).astype(np.float32)
    labels = [i % 4 for i in range(60)]
    text = F.concat(F.lit("topic"), "cluster_id", F.lit("x planning "), "id")
    return vector_table(spark, values, labels).withColumn("request", text)


def completer():
    """Answers by the most frequent topic among the statements of the cluster."""

    def call(prompt):
        own = prompt.split("<answers>")[1].split("</answers>")[0]
        if "topic0x" in own:
            raise RuntimeError("down")
        if "topic1x" in own:
            return "<summary>only this</summary>"
        return "<summary> S\nS </summary> <NAME> N </NAME>"

    return call


def test_names_with_failures_and_missing_tags(spark):
    named = naming.name_clusters(clustered(spark), completer, NamingParams(in_cluster_n=10, out_cluster_n=4))
    rows = {r["cluster_id"]: r for r in named.collect()}
    assert len(rows) == 4
    assert rows[0]["name"].startswith("Summarize") and rows[0]["error"] == "RuntimeError: down"
    assert rows[1]["name"].startswith("Summarize") and rows[1]["raw"] == "<summary>only this</summary>"
    assert (rows[2]["summary"], rows[2]["name"], rows[2]["error"]) == ("S\nS", "N", None)
    assert (rows[3]["in_sample_size"], rows[3]["out_sample_size"]) == (10, 4)
    own = rows[3]["prompt"].split("<answers>\n")[1].split("\n</answers>")[0].split("\n")
    other = rows[3]["prompt"].split("<contrastive_answers>\n")[1].split("\n</contrastive_answers>")[0].split("\n")
    assert len(own) == 10 and all("topic3x" in s for s in own)
    assert len(other) == 4 and not any("topic3x" in s for s in other)

    audit = {r["cluster_id"]: r for r in naming.audit_table(named).collect()}
    assert audit[0]["raw_output"] == f"<summary>{rows[0]['summary']}</summary>\n<name>{rows[0]['name']}</name>"
    assert audit[1]["raw_output"] == rows[1]["raw"]
    assert audit[3]["prompt_path"] == "cluster_003_prompt.txt"


def test_one_cluster_and_no_rows(spark):
    df = clustered(spark)
    params = NamingParams(in_cluster_n=10, out_cluster_n=4)
    assert [r["cluster_id"] for r in naming.name_clusters(df, completer, params, cluster_ids=[2]).collect()] == [2]
    assert naming.name_clusters(df.where("false"), completer, params).count() == 0


def test_rows_without_a_name_keep_nulls(spark):
    names = spark.createDataFrame([(0, "s", "n")], "cluster_id INT, summary STRING, name STRING")
    rows = spark.createDataFrame([(1, 0), (2, 5), (3, None)], "id INT, cluster_id INT")
    found = naming.attach_names(rows, names).orderBy("id").collect()
    assert [(r["id"], r["name"]) for r in found] == [(1, "n"), (2, None), (3, None)]
