import base64
import json
import random
import xml.etree.ElementTree as ET

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from talkatlas.functions import text
from talkatlas.operators import prepare


def column_values(spark, values, build):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i INT, v STRING").select("i", build(F.col("v")).alias("r"))
    return [r["r"] for r in sorted(df.collect(), key=lambda r: r["i"])]


def lenient(encoded):
    """What the standard library makes of the input; nothing on any failure."""
    if not encoded:
        return ""
    try:
        return base64.b64decode(encoded.strip()).decode()
    except ValueError:
        return ""


def damaged_inputs(n):
    draw = random.Random(7)
    for _ in range(n):
        raw = "".join(draw.choice("abé<ü😀 \n") for _ in range(draw.randrange(12)))
        chars = list(base64.b64encode(raw.encode()).decode())
        for _ in range(draw.randrange(4)):
            place = draw.randrange(len(chars) + 1)
            if draw.random() < 0.5:
                chars.insert(place, draw.choice("==A!\n é="))
            elif chars:
                del chars[min(place, len(chars) - 1)]
        yield "".join(chars)


def test_base64_agrees_with_the_standard_library(spark):
    fixed = [None, "", "  ", "aGk", "aGk=", "aGk==", "aGk===", " aGk= ", "a\nG\nk=", "!!!", "/w==", "=", "==="]
    fixed += ["aG=k", "a=Gk=", "aGk=aGk=", "aGVsbG8=QUJD", "aGVsbG8", " aGk= ", "aGké="]
    inputs = fixed + list(damaged_inputs(1500))
    assert column_values(spark, inputs, text.decode_base64) == [lenient(v) for v in inputs]


def test_long_text_with_inner_padding(spark):
    inputs = ["a=" * 20_000 + "aGk=", base64.b64encode(b"x" * 200_000).decode()]
    assert column_values(spark, inputs, text.decode_base64) == [lenient(v) for v in inputs]


def test_turns_of_good_and_bad_json(spark):
    good = [
        '{"turns": [{"role": "user", "text": "a", "more": 1}, {"role": "assistant"}], "x": NaN}',
        ' \n{"turns": []} ',
        '{"turns": [{"text": 5}]}',
    ]
    bad = [
        "", "junk", "[]", "null", "5", "{}", '{"turns": null}', '{"turns": "x"}', '{"turns": [1, 2]}',
        '{"turns": [{"role": "u"}]} junk', '{"turns": [{"role": "u"}]}{"turns": []}',
        '{"turns": [{"role": "u"}]}, {"turns": []}', '[{"turns": [{"role": "u"}]}]',
        "{'turns': [{'role': 'u'}]}", '{"turns": [{"role": "u"}', '{"Turns": [{"role": "u"}]}', None,
    ]
    found = column_values(spark, good + bad, text.parse_turns)
    assert [[tuple(t) for t in turns] for turns in found[: len(good)]] == [
        [("user", "a"), ("assistant", None)],
        [],
        [(None, "5")],
    ]
    assert found[len(good) :] == [[]] * len(bad)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.lists(
            st.tuples(
                st.sampled_from(["user", "assistant", 'a"&<b']),
                st.text(st.characters(codec="utf-8", exclude_categories=["Cc", "Cs"], exclude_characters="￾￿")),
            ),
            max_size=4,
        ),
        min_size=20,
        max_size=40,
    )
)
def test_documents_round_trip(spark, conversations):
    raw = []
    for i, turns in enumerate(conversations):
        content = json.dumps({"turns": [{"role": r, "text": t} for r, t in turns]}, ensure_ascii=i % 2 == 0)
        encoded = base64.b64encode(content.encode()).decode()
        raw.append((f"<{i}>", "2025-10-10T17:21", "" if i % 3 == 0 else f'"{i}" & co', "tag", encoded))
    df = spark.createDataFrame(raw, "id STRING, created_dttm STRING, title STRING, tags STRING, encoded_content STRING")
    found = {r["id"]: r["conversation_xml"] for r in prepare.conversation_documents(df).collect()}
    for row, turns in zip(raw, conversations, strict=True):
        root = ET.fromstring(found[row[0]])
        assert root.get("id") == row[0]
        assert [(t.get("role"), t.text or "") for t in root.findall("turn")] == list(turns)
        assert root.findtext("meta/timestamp") == row[1]
        assert root.findtext("meta/title") == (row[2] or None)


def test_document_layout(spark):
    df = spark.sql(
        """SELECT 7 AS id, '2025' AS created_dttm, CAST(NULL AS STRING) AS title,
           array(named_struct('role', 'user', 'text', 'Tom & "Al"'), named_struct('role', NULL, 'text', NULL)) AS turns"""
    )
    assert prepare.add_xml(df).first()["conversation_xml"] == (
        '<conversation id="7">\n  <meta>\n    <timestamp>2025</timestamp>\n  </meta>\n'
        '  <turn role="user">Tom &amp; &quot;Al&quot;</turn>\n  <turn role=""></turn>\n</conversation>'
    )


def test_tags(spark):
    answers = ["<Name>  a\nb \x1c</NAME><name>c</name>", "<name></name>", "<name>open", "none", None]
    assert column_values(spark, answers, lambda c: text.tag_text(c, "name")) == ["a\nb", "", "", "", ""]


@pytest.mark.parametrize(
    "after",
    ["]", " ]", "}", "}]", "}] junk", "] junk", ",", ', {"end": ""}', ',{"end":"x"}]', "]]", "null", '"', " x", ' , {"turns": []}'],
)
def test_text_after_the_object_is_damage(spark, after):
    whole = '{"turns":[{"role":"user","text":"hi"}]}'
    found = column_values(spark, [whole, whole + after, whole + " \n"], text.parse_turns)
    assert [[tuple(t) for t in f] for f in found] == [[("user", "hi")], [], [("user", "hi")]]


@given(st.lists(st.text("]}[{\",: ax\n0", max_size=5), min_size=1, max_size=8))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_any_suffix_agrees_with_the_standard_parser(spark, suffixes):
    texts = ['{"turns":[{"role":"user","text":"hi"}]}' + s for s in suffixes]

    def valid(t):
        try:
            return isinstance(json.loads(t), dict)
        except ValueError:
            return False

    assert [len(f) == 1 for f in column_values(spark, texts, text.parse_turns)] == [valid(t) for t in texts]


def test_statements(spark):
    df = spark.sql("SELECT array(' a ', '', NULL, ' \n', 'b') AS s")
    assert df.select(text.statement_block(F.col("s"))).first()[0] == "a\nb"


def test_concern_score(spark):
    values = ["1", " 5 ", "0", "6", "", "two", "2.5", None]
    assert column_values(spark, values, text.concern_score) == [1, 5] + [None] * 6
