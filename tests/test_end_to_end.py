import uuid

from talkatlas import schemas
from talkatlas.operators import cluster, facets, naming, prepare, project
from talkatlas.operators.embed import embed, hashing_encoder
from talkatlas.plans.catalog import raw_conversations
from talkatlas.plans.end_to_end import analyse
from talkatlas.plans.stubs import stub_facet_completer, stub_naming_completer
from talkatlas.runtime import shared_dir
from talkatlas.sources import tables


def test_all_stages(spark, tmp_path):
    raw = raw_conversations(spark, "/root/testdata/sf0.001")
    tables.write_csv(raw, str(tmp_path / "raw"))
    rows = analyse(
        tables.read_raw_conversations(spark, str(tmp_path / "raw")),
        str(tmp_path / "out"),
        stub_facet_completer,
        hashing_encoder(32),
        stub_naming_completer,
    ).collect()
    assert len(rows) == raw.count() == len({r["id"] for r in rows})
    assert {r["cluster_id"] for r in rows} <= {0, 1, 2}
    assert all(r["name"] and r["summary"] and r["x"] is not None for r in rows)
    names = spark.read.parquet(str(tmp_path / "out/cluster_names")).collect()
    assert {r["name"] for r in rows} == {r["name"] for r in names}
    parents = tables.read_hierarchy(spark, str(tmp_path / "out/hierarchy")).first()["parents"]
    assert parents[0]["child_cluster_ids"] == sorted({r["cluster_id"] for r in rows})
    stored = tables.read_table(spark, str(tmp_path / "out/embeddings"), schemas.EMBEDDINGS)
    assert stored.count() == len(rows)
    near = tables.read_table(spark, str(tmp_path / "out/neighbors"))
    assert near.where("rank <= 15").count() == near.count() == len(rows) * min(15, len(rows) - 1)


def test_a_long_conversation_is_one_record(spark):
    turns = [(7, i, "user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(500)]
    path = f"{shared_dir(spark)}/long-{uuid.uuid4().hex}"
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(
        f"{path}/conversations.parquet"
    )
    raw = raw_conversations(spark, path)
    assert [(r["id"], len(r["turns"])) for r in prepare.add_turns(raw).collect()] == [("7", 500)]
    found = facets.extract_facets(prepare.conversation_documents(raw), stub_facet_completer).collect()
    assert [(r["id"], r["task"]) for r in found] == [("7", "The task is to reply to 250 user turns.")]


def test_names_are_asked_for_in_several_tasks(spark):
    rows = spark.range(400).selectExpr(
        "id", "cast(id % 8 AS int) AS cluster_id", "concat('word', id % 8, ' text ', id) AS request"
    )
    rows = embed(rows, hashing_encoder(16), keep=("request", "cluster_id"))

    def completer():
        import uuid

        task = uuid.uuid4().hex
        return lambda prompt: f"<summary>{task}</summary><name>{task}</name>"

    named = naming.name_clusters(rows, completer, calls_in_flight=2).collect()
    assert len(named) == 8 and len({r["name"] for r in named}) > 1


def test_rows_without_a_vector_stay(spark):
    rows = spark.createDataFrame([(i, [float(i), 1.0, i * i * 0.5]) for i in range(9)] + [(9, None)], "id long, embedding array<float>")
    labels, _ = cluster.fit_kmeans(rows, 3)
    assert {r["id"]: r["cluster_id"] is None for r in labels.collect()} == {i: i == 9 for i in range(10)}
    projected = project.project_and_merge(rows).collect()
    assert {r["id"]: r["x"] is None for r in projected} == {i: i == 9 for i in range(10)}
