import json

import numpy as np
import pytest
from test_cluster import vector_table

from talkatlas import schemas
from talkatlas.operators import hierarchy
from talkatlas.sources import tables
from talkatlas.sources.text_files import TextFiles

ODD = ['a,"b"\nc', "  spaced\t", "\r\n", '"', "back\\slash\\", "\\\"", "'", "é x", "plain", "#x"]


def test_csv_keeps_odd_texts(spark, tmp_path):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(ODD)], schemas.CONVERSATION_XML)
    tables.write_csv(df, str(tmp_path / "x"))
    found = {r["id"]: r["conversation_xml"] for r in tables.read_conversation_xml_csv(spark, str(tmp_path / "x")).collect()}
    assert [found[str(i)] for i in range(len(ODD))] == ODD


def test_empty_facets_come_back_as_null(spark, tmp_path):
    df = spark.createDataFrame([("1", "r", "", "t", "2"), ("2", "r2", None, "", "")], schemas.FACETS)
    tables.write_csv(df, str(tmp_path / "f"))
    found = sorted(tables.read_facets_csv(spark, str(tmp_path / "f")).collect())
    assert [tuple(r) for r in found] == [("1", "r", None, "t", "2"), ("2", "r2", None, None, None)]


def test_raw_csv_from_another_tool(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('id,created_dttm,title,tags,encoded_content\n7,2025-10-10T17:21,"Say ""hi""\nnow",x,eyJ0dXJucyI6W119\n')
    row = tables.read_raw_conversations(spark, str(path)).first()
    assert tuple(row) == ("7", "2025-10-10T17:21", 'Say "hi"\nnow', "x", "eyJ0dXJucyI6W119")


def test_embeddings_and_names(spark, tmp_path):
    df = spark.createDataFrame([("a", [1.0, 2.0])], schemas.EMBEDDINGS)
    tables.write_table(df, str(tmp_path / "e"))
    assert tables.read_embeddings(spark, str(tmp_path / "e")).collect() == df.collect()

    names = spark.createDataFrame([(0, "s, \"q\"", "n"), (1, None, "m")], schemas.CLUSTER_NAMES)
    csv, jsonl = str(tmp_path / "c"), str(tmp_path / "j")
    tables.write_cluster_names(names, csv, jsonl)
    assert sorted(tables.read_csv(spark, csv, schemas.CLUSTER_NAMES).collect()) == sorted(names.collect())
    assert sorted(tables.read_cluster_names(spark, jsonl).collect()) == sorted(names.collect())
    lines = [json.loads(r["value"]) for r in spark.read.text(jsonl).collect()]
    assert {"cluster_id": 1, "summary": None, "name": "m"} in lines


def test_audit_texts(spark, tmp_path):
    named = spark.createDataFrame(
        [(3, "S", "N", "ask\nthis", None)], "cluster_id INT, summary STRING, name STRING, prompt STRING, raw STRING"
    )
    folder = tmp_path / "t"
    for _ in range(2):
        tables.write_audit_texts(named, str(folder))
    assert {p.name: p.read_text() for p in folder.iterdir() if not p.name.endswith(".crc")} == {
        "cluster_003_prompt.txt": "ask\nthis",
        "cluster_003_output.txt": "<summary>S</summary>\n<name>N</name>",
    }


def test_a_failed_write_leaves_no_files(spark, tmp_path):
    spark.dataSource.register(TextFiles)
    rows = spark.createDataFrame([("a.txt", "x"), ("b/c.txt", "y")], "file STRING, value STRING").coalesce(1)
    with pytest.raises(Exception, match="not a file name"):
        rows.write.format("text_files").mode("append").save(f"file://{tmp_path}/t")
    assert list((tmp_path / "t").iterdir()) == []
    with pytest.raises(Exception, match="columns file and value"):
        rows.select("file").write.format("text_files").mode("append").save(f"file://{tmp_path}/t")


def test_hierarchy_json(spark, tmp_path):
    doc = hierarchy.build_hierarchy(vector_table(spark, np.eye(3, dtype=np.float32), [0, 1, 2]))
    tables.write_hierarchy(doc, str(tmp_path / "h"))
    assert tables.read_hierarchy(spark, str(tmp_path / "h")).collect() == doc.collect()


def test_one_line_csv_keeps_texts_and_splits(spark, tmp_path):
    odd = ["a\nb", "\r\n", "\\n", "\\", "\\s\\r", ' "x", y\n', None, "é"]
    rows = spark.createDataFrame(list(enumerate(odd)), "id int, text string")
    tables.write_csv(rows.coalesce(1), str(tmp_path / "t"), one_line=True)
    found = tables.read_csv(spark, str(tmp_path / "t"), "id int, text string", one_line=True).collect()
    assert [r["text"] for r in sorted(found, key=lambda r: r["id"])] == odd
    lines = spark.read.text(str(tmp_path / "t")).count()
    assert lines == len(odd) + 1
