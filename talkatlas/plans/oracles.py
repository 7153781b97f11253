"""The catalogue's queries as plain SQL for DuckDB, written independently.

Texts that both sides must share (patterns, prompts, word lists) are taken from
the library; the computing is not.
"""

from __future__ import annotations

from talkatlas.functions.text import STOP_WORDS, TOKEN_PATTERN, WHITESPACE
from talkatlas.operators import facets, naming
from talkatlas.params import DEFAULT_CRITERIA
from talkatlas.plans import stubs
from talkatlas.plans.catalog import (
    BIN_WIDTH,
    COMPLETE_THRESHOLD,
    KNN,
    LANGUAGES,
    DIM,
    KMEANS_STEPS,
    LLOYD_STEPS,
    THRESHOLD,
)


def _lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


SPACE = _lit(WHITESPACE)
NL = "chr(10)"


def _esc(expr: str) -> str:
    for plain, entity in (
        ("&", "&amp;"),
        ("<", "&lt;"),
        (">", "&gt;"),
        ('"', "&quot;"),
        ("'", "&apos;"),
    ):
        expr = f"replace({expr}, {_lit(plain)}, {_lit(entity)})"
    return expr


RECORDS = f"""
records AS (
  SELECT conv_id::VARCHAR AS id, conv_id, turn, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place
  FROM conversations
)"""

XML = f"""{RECORDS},
xml AS (
  SELECT id, concat(
    '<conversation id="', id, '">', {NL}, '  <meta>', {NL},
    '    <timestamp>2025-01-', lpad((conv_id % 28 + 1)::VARCHAR, 2, '0'), 'T00:00</timestamp>', {NL},
    CASE WHEN conv_id % 3 <> 0
      THEN concat('    <title>Q&amp;A &quot;', conv_id, '&quot;</title>', {NL}) ELSE '' END,
    '  </meta>', {NL},
    string_agg(concat('  <turn role="', {_esc("role")}, '">', {_esc("text")}, '</turn>'), {NL} ORDER BY turn),
    {NL}, '</conversation>') AS conversation_xml
  FROM records GROUP BY id, conv_id
)"""


def _language() -> str:
    whens = " ".join(
        f"WHEN contains(words, {_lit(mark)}) THEN {_lit(name)}" for mark, name in stubs.LANGUAGE_MARKS
    )
    return f"CASE {whens} ELSE {_lit(stubs.OTHER_LANGUAGE)} END"


FACETS = f"""{RECORDS},
turns AS (
  SELECT id, count(*) AS n, count(*) FILTER (role = 'user') AS asked,
         arg_min({_esc("text")}, turn) FILTER (role = 'user') AS first_text,
         lower(string_agg({_esc("text")}, ' ' ORDER BY turn)) AS words
  FROM records GROUP BY id
),
facets AS (
  SELECT id,
         CASE WHEN asked > 0
           THEN concat({_lit(stubs.REQUEST_START)}, trim(first_text, {SPACE})) ELSE '' END AS request,
         {_language()} AS language,
         concat('The task is to reply to ', asked, ' user turns.') AS task,
         (1 + n % 5)::VARCHAR AS concerning
  FROM turns
)"""

EMBEDDINGS = "e AS (SELECT vec_id AS id, label AS cluster_id, embedding::DOUBLE[] AS v FROM embeddings)"


def _hashed(source: str) -> str:
    """``hashed``: the hash embedding of ``source(id, cluster_id, text)``, as dense vectors."""
    return f"""
hash_words AS (
  SELECT id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS t FROM {source}),
hash_counts AS (
  SELECT id, (('0x' || substr(md5(t), 1, 8))::BIGINT % {DIM})::INTEGER AS bucket, count(*) AS c
  FROM hash_words GROUP BY ALL),
hash_weights AS (
  SELECT id, bucket, (c / sqrt(sum(c * c) OVER (PARTITION BY id)::DOUBLE))::FLOAT::DOUBLE AS w FROM hash_counts),
hash_places AS (SELECT id, cluster_id, unnest(range({DIM}))::INTEGER AS bucket FROM {source}),
hashed AS (
  SELECT id, cluster_id, list(coalesce(w, 0.0) ORDER BY bucket) AS v
  FROM hash_places LEFT JOIN hash_weights USING (id, bucket) GROUP BY id, cluster_id)"""


MEANS = """
parts AS (SELECT id, cluster_id, unnest(range(len(v))) AS pos, unnest(v) AS x FROM e),
means AS (
  SELECT cluster_id, pos, avg(x) AS m, count(*) AS n FROM parts
  WHERE cluster_id IS NOT NULL GROUP BY cluster_id, pos
),
cent AS (SELECT cluster_id, max(n) AS n, list(m ORDER BY pos) AS c FROM means GROUP BY cluster_id)"""
VECTORS = f"{EMBEDDINGS},{MEANS}"


def _examples(n_in: int, n_out: int, seed: int, vectors: str = VECTORS) -> str:
    return f"""{vectors},
inside AS (
  SELECT cluster_id, id, row_number() OVER (
    PARTITION BY cluster_id
    ORDER BY md5(concat_ws(':', {seed} + cluster_id, cluster_id, id)), id) AS rank
  FROM e WHERE cluster_id IS NOT NULL QUALIFY rank <= {n_in}
),
outside AS (
  SELECT cent.cluster_id, e.id, list_distance(e.v, cent.c) AS distance, row_number() OVER (
    PARTITION BY cent.cluster_id ORDER BY list_distance(e.v, cent.c), e.id) AS rank
  FROM e JOIN cent ON e.cluster_id <> cent.cluster_id QUALIFY rank <= {n_out}
)"""


def _tokens(source: str) -> str:
    stop = ", ".join(_lit(w) for w in STOP_WORDS)
    return f"""
words AS (
  SELECT cluster_id, rank AS row_rank, unnest(w) AS token, unnest(range(len(w))) AS place FROM (
    SELECT cluster_id, rank, regexp_extract_all(lower(text), {_lit(TOKEN_PATTERN)}) AS w FROM {source})
),
counted AS (
  SELECT cluster_id, token, count(*) AS n, min(row_rank * 100000000 + place) AS first
  FROM words WHERE token NOT IN ({stop}) GROUP BY cluster_id, token
),
best AS (
  SELECT cluster_id, token, n, row_number() OVER (
    PARTITION BY cluster_id ORDER BY n DESC, first) AS rank
  FROM counted QUALIFY rank <= 6
),
fallback AS (
  SELECT s.cluster_id,
    concat({_lit(naming.FALLBACK_SUMMARY_START)}, coalesce(string_agg(token, ', ' ORDER BY rank), '')) AS summary,
    substr(concat_ws(' ', 'Summarize', string_agg(concat(upper(token[1]), token[2:]), ' ' ORDER BY rank)
      FILTER (rank <= 4)), 1, 80) AS name
  FROM (SELECT DISTINCT cluster_id FROM {source}) s LEFT JOIN best USING (cluster_id) GROUP BY s.cluster_id
)"""


LANGUAGE_TEXTS = f"""
texts AS (
  SELECT coalesce(list_position({list(LANGUAGES)!r}, lang), 0)::INTEGER AS cluster_id, doc_id AS rank, text
  FROM documents
)"""


DOCUMENTS = f"""
docs AS (
  SELECT doc_id AS id, coalesce(list_position({list(LANGUAGES)!r}, lang), 0)::INTEGER AS cluster_id, text
  FROM documents)"""
DOCUMENT_VECTORS = f"""{DOCUMENTS},
{_hashed("docs")},
e AS (SELECT * FROM hashed), {MEANS}"""


def _naming(vectors: str = DOCUMENT_VECTORS, texts: str = "docs") -> str:
    """``named`` for clustered vectors and the table of their texts by id."""
    head, _, rest = _prompt_template().partition("\0in\0")
    middle, _, tail = rest.partition("\0out\0")
    lines = f"string_agg(trim(d.text, {SPACE}), {NL} ORDER BY rank) FILTER (trim(d.text, {SPACE}) <> '')"
    return f"""{_examples(20, 10, 123, vectors)},
in_texts AS (SELECT i.cluster_id, i.rank, d.text FROM inside i JOIN (SELECT id, text FROM {texts}) d USING (id)),
in_block AS (
  SELECT i.cluster_id, count(*) AS n, coalesce({lines}, '') AS block
  FROM inside i JOIN (SELECT id, text FROM {texts}) d USING (id) GROUP BY i.cluster_id),
out_block AS (
  SELECT o.cluster_id, count(*) AS n, coalesce({lines}, '') AS block
  FROM outside o JOIN (SELECT id, text FROM {texts}) d USING (id) GROUP BY o.cluster_id),
prompts AS (
  SELECT cluster_id, in_block.n AS in_sample_size, coalesce(out_block.n, 0) AS out_sample_size,
    concat({_lit(head)}, in_block.block, {_lit(middle)}, out_block.block, {_lit(tail)}) AS prompt
  FROM in_block LEFT JOIN out_block USING (cluster_id)),
{_tokens("in_texts")},
answers AS (
  SELECT *, md5(prompt) AS digest, md5(prompt)[1] IN ('0', '1', '2', '3') AS failed,
    md5(prompt)[1] IN ('4', '5', '6', '7') AS nameless
  FROM prompts JOIN fallback USING (cluster_id)),
named AS (
  SELECT cluster_id, in_sample_size, out_sample_size, prompt, digest,
    CASE WHEN failed OR nameless THEN summary ELSE concat('About ', digest, '.') END AS summary,
    CASE WHEN failed OR nameless THEN name ELSE concat('Name ', digest) END AS name,
    CASE WHEN failed THEN concat('<summary>', summary, '</summary>', {NL}, '<name>', name, '</name>')
      WHEN nameless THEN concat('<summary>About ', digest, '.</summary>')
      ELSE concat('Sure.', {NL}, '<Summary> About ', digest, '. </Summary>', {NL}, '<NAME>', {NL},
        'Name ', digest, {NL}, '</NAME>') END AS raw_output
  FROM answers)"""


def _prompt_template() -> str:
    return (
        f"{naming.INSTRUCTIONS}<criteria>\n{DEFAULT_CRITERIA}\n</criteria>\n\nThe statements:\n<answers>\n"
        "\0in\0\n</answers>\n\nStatements from nearby groups that do NOT belong to this one:\n"
        f"<contrastive_answers>\n\0out\0\n</contrastive_answers>{naming.CLOSING}"
    )


PAIRS = f"""{VECTORS},
pairs AS (
  SELECT a.cluster_id AS a, b.cluster_id AS b, list_cosine_distance(a.c, b.c) AS distance
  FROM cent a JOIN cent b ON a.cluster_id < b.cluster_id
)"""

# Principal axes by repeated squaring of the covariance matrix.
PROJECTION = """
raw AS (SELECT vec_id AS id, label AS cluster_id, embedding::DOUBLE[] AS v FROM embeddings),
units AS (
  SELECT id, cluster_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM raw),
parts AS (SELECT id, unnest(range(len(u))) AS pos, unnest(u) AS x FROM units),
means AS (SELECT pos, avg(x) AS m FROM parts GROUP BY pos),
centered AS (SELECT id, pos, x - m AS x FROM parts JOIN means USING (pos)),
cov AS (
  SELECT a.pos AS i, b.pos AS j, sum(a.x * b.x) AS c
  FROM centered a JOIN centered b ON a.id = b.id GROUP BY a.pos, b.pos),
rows1 AS (SELECT i, list(c ORDER BY j) AS r FROM cov GROUP BY i),
m1 AS (SELECT list(r ORDER BY i) AS m FROM rows1),
sq1 AS (
  SELECT 0 AS step, m FROM m1
  UNION ALL
  SELECT step + 1, list_transform(m2, lambda r: list_transform(r, lambda x: x / top)) FROM (
    SELECT step, m2, list_max(list_transform(m2, lambda r: list_max(r))) AS top FROM (
      SELECT step, list_transform(m, lambda r: list_transform(m, lambda c: list_dot_product(r, c))) AS m2
      FROM sq1 WHERE step < 40))
),
axis1 AS (
  SELECT list_transform(r, lambda x: x / sqrt(list_dot_product(r, r))) AS w FROM (
    SELECT m[1 + list_position(diag, list_max(diag)) - 1] AS r FROM (
      SELECT m, list_transform(range(1, len(m) + 1), lambda i: m[i][i]) AS diag FROM sq1 WHERE step = 40))
),
top1 AS (
  SELECT w, list_dot_product(w, list_transform(m, lambda r: list_dot_product(r, w))) AS ev FROM axis1, m1),
m1b AS (
  SELECT list_transform(range(1, len(m) + 1), lambda i: list_transform(range(1, len(m) + 1),
    lambda j: m[i][j] - ev * w[i] * w[j])) AS m FROM m1, top1),
sq2 AS (
  SELECT 0 AS step, m FROM m1b
  UNION ALL
  SELECT step + 1, list_transform(m2, lambda r: list_transform(r, lambda x: x / top)) FROM (
    SELECT step, m2, list_max(list_transform(m2, lambda r: list_max(r))) AS top FROM (
      SELECT step, list_transform(m, lambda r: list_transform(m, lambda c: list_dot_product(r, c))) AS m2
      FROM sq2 WHERE step < 40))
),
axis2 AS (
  SELECT list_transform(r, lambda x: x / sqrt(list_dot_product(r, r))) AS w FROM (
    SELECT m[1 + list_position(diag, list_max(diag)) - 1] AS r FROM (
      SELECT m, list_transform(range(1, len(m) + 1), lambda i: m[i][i]) AS diag FROM sq2 WHERE step = 40))
),
signed AS (
  SELECT list_transform(a.w, lambda x: CASE WHEN list_max(a.w) >= -list_min(a.w) THEN x ELSE -x END) AS w1,
         list_transform(b.w, lambda x: CASE WHEN list_max(b.w) >= -list_min(b.w) THEN x ELSE -x END) AS w2
  FROM axis1 a, axis2 b),
coords AS (
  SELECT id, cluster_id, list_dot_product(u, w1) AS x, list_dot_product(u, w2) AS y FROM units, signed)"""


def _moves(first: int, last: int) -> list[str]:
    """Centroids ``s{first + 1}`` to ``s{last}`` from ``s{first}``, ``e`` and ``parts``."""
    return [
        f"""
a{i} AS MATERIALIZED (
  SELECT e.id, arg_min(s.cluster_id, list_distance(e.v, s.c)) AS cluster_id FROM e, s{i} s GROUP BY e.id),
m{i} AS (
  SELECT a.cluster_id, pos, avg(x) AS m, count(*) AS n FROM a{i} a JOIN parts p ON a.id = p.id
  GROUP BY a.cluster_id, pos),
g{i} AS (SELECT cluster_id, max(n) AS n, list(m ORDER BY pos) AS c FROM m{i} GROUP BY cluster_id),
s{i + 1} AS MATERIALIZED (
  SELECT s.cluster_id, coalesce(g.n, 0) AS n, coalesce(g.c, s.c) AS c
  FROM s{i} s LEFT JOIN g{i} g USING (cluster_id))"""
        for i in range(first, last)
    ]


def _lloyd_steps() -> str:
    """``s0`` to the last centroids, from ``e`` and ``parts``."""
    start = """
s0 AS (
  SELECT place AS cluster_id, v AS c
  FROM (SELECT v, row_number() OVER (ORDER BY md5(id::VARCHAR), id) - 1 AS place FROM e)
  WHERE place < (SELECT least(greatest(3, count(*) // 50), 40) FROM e))"""
    return ", ".join([start, *_moves(0, LLOYD_STEPS)])


def _draw(text: str) -> str:
    return f"((('0x' || substr(md5({text}), 1, 8))::BIGINT + 0.5) / 4294967296.0)"


def _kmeans(rounds: int = 5, seed: int = 42) -> str:
    """Start points drawn in rounds and reduced by weight, Lloyd's steps, labels by size."""
    drawn = [
        f"""
size_ AS (SELECT least(greatest(3, count(*) // 50), 40) AS k FROM e),
d0 AS MATERIALIZED (SELECT 0 AS turn, 0.0::DOUBLE AS key, id, v FROM e ORDER BY {_draw(f"'{seed}:0:' || id")}, id LIMIT 1)"""
    ]
    for i in range(1, rounds + 1):
        drawn.append(f"""
f{i} AS (
  SELECT e.id, any_value(e.v) AS v, min(list_distance(e.v, d.v)) AS gap FROM e, d{i - 1} d GROUP BY e.id),
d{i} AS MATERIALIZED (
  SELECT * FROM d{i - 1} UNION ALL
  SELECT * FROM (
    SELECT {i}, -ln({_draw(f"'{seed}:{i}:' || id")}) / gap / gap AS key, id, v FROM f{i}
    WHERE gap > 0 ORDER BY key, id LIMIT (SELECT 2 * k FROM size_)))""")
    return f"""WITH RECURSIVE {VECTORS}, {", ".join(drawn)},
numbered AS MATERIALIZED (SELECT row_number() OVER (ORDER BY turn, key, id) AS place, v FROM d{rounds}),
nearest AS (
  SELECT e.id, min(struct_pack(gap := list_distance(e.v, n.v), place := n.place)).place AS place
  FROM e, numbered n GROUP BY e.id),
weights AS (
  SELECT place, v, (SELECT count(*) FROM nearest WHERE nearest.place = n.place)::DOUBLE AS w FROM numbered n),
grid AS (
  SELECT a.place, list(list_distance(a.v, b.v) * list_distance(a.v, b.v) ORDER BY b.place) AS gaps
  FROM weights a, weights b GROUP BY a.place),
packed AS MATERIALIZED (
  SELECT (SELECT list(w ORDER BY place) FROM weights) AS w, (SELECT list(gaps ORDER BY place) FROM grid) AS gaps,
         (SELECT k FROM size_) AS k),
picks AS (
  SELECT 0 AS step, []::BIGINT[] AS chosen, w AS score FROM packed
  UNION ALL
  SELECT step + 1, list_append(chosen, pick), list_transform(range(1, len(w) + 1),
    lambda i: w[i] * list_min(list_transform(list_append(chosen, pick), lambda c: gaps[c][i])))
  FROM (
    SELECT step, chosen, score, w, gaps, 1 + len(list_filter(
      list_transform(range(1, len(score) + 1), lambda i: list_sum(score[1:i])),
      lambda x: x <= list_sum(score) * {_draw(f"'{seed}:pick:' || step")})) AS pick
    FROM picks, packed WHERE step < k AND list_sum(score) > 0)),
s0 AS MATERIALIZED (
  SELECT p - 1 AS cluster_id, v AS c FROM (
    SELECT unnest(chosen) AS place, unnest(range(1, len(chosen) + 1)) AS p FROM picks ORDER BY step DESC LIMIT (SELECT k FROM size_))
  JOIN numbered USING (place)), {", ".join(_moves(0, KMEANS_STEPS))},
ended AS (
  SELECT e.id, arg_min(s.cluster_id, list_distance(e.v, s.c)) AS cluster_id FROM e, s{KMEANS_STEPS} s GROUP BY e.id),
ordered AS (
  SELECT cluster_id, row_number() OVER (ORDER BY size DESC, c) - 1 AS number
  FROM (SELECT cluster_id, count(*) AS size FROM ended GROUP BY 1) JOIN s{KMEANS_STEPS} USING (cluster_id))
SELECT id, number::INTEGER AS cluster_id FROM ended JOIN ordered USING (cluster_id)"""


def _lloyd() -> str:
    return f"""WITH {VECTORS}, {_lloyd_steps()}
SELECT cluster_id::INTEGER AS cluster_id, n, unnest(range(len(c)))::INTEGER AS pos, round(unnest(c), 6) + 0.0 AS value
FROM s{LLOYD_STEPS}"""


def _flagship() -> str:
    """Facets, their vectors, Lloyd's steps, and names of the clusters."""
    points = f"""{FACETS},
asked AS (SELECT id, NULL::INTEGER AS cluster_id, request AS text FROM facets),
{_hashed("asked")},
raw AS (SELECT * FROM hashed),
{{start}}
placed AS MATERIALIZED (
  SELECT raw.id, arg_min(s.cluster_id, list_distance(raw.v, s.c))::INTEGER AS cluster_id
  FROM raw, s{LLOYD_STEPS} s GROUP BY raw.id),
e AS (SELECT id, placed.cluster_id, raw.v FROM raw JOIN placed USING (id)), {MEANS}"""
    start = "raw_parts AS (SELECT id, unnest(range(len(v))) AS pos, unnest(v) AS x FROM raw)," + _lloyd_steps().replace(
        " e.", " raw."
    ).replace("FROM e,", "FROM raw,").replace("FROM e)", "FROM raw)").replace("JOIN parts p", "JOIN raw_parts p").replace(
        "(e.", "(raw."
    )
    return f"""WITH {_naming(points.format(start=f"{start},"), "asked")}
SELECT facets.*, e.cluster_id, summary, name FROM facets JOIN e USING (id) LEFT JOIN named USING (cluster_id)"""


def _facet_prompts() -> str:
    kinds = [("batched", facets.BATCHED_TAIL)]
    kinds += [(s.key, facets.facet_tail(s)) for s in facets.FACET_SPECS]
    parts = [
        f"SELECT id, {_lit(kind)} AS kind, concat({_lit(facets.SHOWN)}, conversation_xml, {_lit(tail)}) AS p FROM xml"
        for kind, tail in kinds
    ]
    return f"""WITH {XML}, p AS ({" UNION ALL ".join(parts)})
SELECT id, kind, md5(p) AS hash, length(p) AS length FROM p"""


HIERARCHY_COMPONENTS = f"""WITH RECURSIVE {PAIRS},
edges AS (
  SELECT a AS x, b AS y FROM pairs WHERE distance < {THRESHOLD}
  UNION ALL SELECT b, a FROM pairs WHERE distance < {THRESHOLD}),
reach AS (
  SELECT cluster_id AS a, cluster_id AS b FROM cent
  UNION SELECT r.a, g.y FROM reach r JOIN edges g ON r.b = g.x),
roots AS (SELECT a AS cluster_id, min(b) AS root FROM reach GROUP BY a)
SELECT (dense_rank() OVER (ORDER BY root) - 1)::INTEGER AS parent_id,
  string_agg(cluster_id::VARCHAR, ',' ORDER BY cluster_id) AS children
FROM roots GROUP BY root"""

def _agglomerated(measure: str, stop: str) -> str:
    """Groups merged one pair at a time, the nearest by ``measure``, until ``stop``."""
    return f"""WITH RECURSIVE {PAIRS},
places AS (SELECT cluster_id, row_number() OVER (ORDER BY cluster_id) AS p FROM cent),
gaps AS (
  SELECT pa.p AS i, pb.p AS j, distance FROM pairs
  JOIN places pa ON pa.cluster_id = a JOIN places pb ON pb.cluster_id = b),
steps AS (
  SELECT 0 AS s, list(p ORDER BY p) AS labels FROM places
  UNION ALL
  SELECT s + 1, list_transform(labels, lambda l: CASE WHEN l = best.h THEN best.g ELSE l END) FROM (
    SELECT s, labels, arg_min({{'g': g, 'h': h}}, gap) AS best FROM (
      SELECT s, labels, least(labels[i], labels[j]) AS g, greatest(labels[i], labels[j]) AS h, {measure}(distance) AS gap
      FROM steps, gaps WHERE labels[i] <> labels[j] GROUP BY ALL)
    GROUP BY s, labels HAVING {stop})
),
final AS (SELECT labels FROM steps ORDER BY s DESC LIMIT 1),
grouped AS (SELECT cluster_id, labels[p] AS root FROM places, final)
SELECT (dense_rank() OVER (ORDER BY root) - 1)::INTEGER AS parent_id,
  string_agg(cluster_id::VARCHAR, ',' ORDER BY cluster_id) AS children
FROM grouped GROUP BY root"""


def _named_rows(key: str) -> str:
    return f"""WITH {DOCUMENTS},
texts AS (SELECT cluster_id, id AS rank, text FROM docs WHERE cluster_id % 2 = 0),
{_tokens("texts")}
SELECT {key}, docs.cluster_id, summary, name FROM docs LEFT JOIN fallback ON docs.cluster_id = fallback.cluster_id"""


def oracle_sql() -> dict[str, str]:
    return {
        "decode_turns": f"WITH {RECORDS} SELECT id, place::INTEGER AS place, role, text FROM records",
        "decode_bad_input": """
            SELECT doc_id, (doc_id % 12 IN (1, 7, 8, 9))::INTEGER AS n,
              CASE WHEN doc_id % 12 IN (1, 7, 8, 9) THEN concat('Oh, ', text) END AS text FROM documents""",
        "conversation_xml": f"WITH {XML} SELECT id, conversation_xml FROM xml",
        "xml_escape_pages": f"SELECT page_id, {_esc('html')} AS escaped FROM pages",
        "facets_batched": f"WITH {FACETS} SELECT * FROM facets",
        "facets_sequential": f"WITH {FACETS} SELECT * FROM facets",
        "facets_sequential_logged": f"WITH {FACETS} SELECT * FROM facets",
        "flagship": _flagship(),
        "raw_csv_roundtrip": f"""WITH {RECORDS}
            SELECT id, concat('2025-01-', lpad((conv_id % 28 + 1)::VARCHAR, 2, '0'), 'T00:00') AS created_dttm,
              CASE WHEN conv_id % 3 <> 0 THEN concat('Q&A "', conv_id, '"') END AS title,
              'chat' AS tags, count(*)::INTEGER AS n_turns
            FROM records GROUP BY id, conv_id""",
        "concern_histogram": f"""WITH {FACETS}
            SELECT concerning::INTEGER AS concern_score, count(*) AS count FROM facets GROUP BY 1""",
        "facet_prompts": _facet_prompts(),
        "facet_tags_parse": f"""
            SELECT doc_id, CASE WHEN lost THEN '' ELSE trim(text, {SPACE}) END AS request,
              CASE WHEN lost OR doc_id % 3 = 0 THEN '' ELSE lang END AS language,
              CASE WHEN lost OR doc_id % 2 = 0 THEN '' ELSE concat('do', {NL}, 'it') END AS task,
              CASE WHEN lost THEN '' ELSE (doc_id % 8)::VARCHAR END AS concerning,
              CASE WHEN lost THEN '' ELSE source END AS answer,
              CASE WHEN NOT lost AND doc_id % 8 BETWEEN 1 AND 5 THEN (doc_id % 8)::INTEGER END AS concern_score
            FROM (SELECT *, doc_id % 11 = 0 AS lost FROM documents)""",
        "hash_embed": """
            WITH words AS (
              SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS t FROM documents),
            counts AS (
              SELECT id, (('0x' || substr(md5(t), 1, 8))::BIGINT % 64)::INTEGER AS bucket, count(*) AS c
              FROM words GROUP BY ALL)
            SELECT id, bucket, round((c / sqrt(sum(c * c) OVER (PARTITION BY id)::DOUBLE))::FLOAT::DOUBLE, 6) AS w
            FROM counts""",
        "idf_embed": f"""
            WITH words AS (
              SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS t FROM documents),
            counts AS (
              SELECT id, (('0x' || substr(md5(t), 1, 8))::BIGINT % {DIM})::INTEGER AS bucket, count(*) AS c
              FROM words GROUP BY ALL),
            rarity AS (
              SELECT bucket, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)::DOUBLE) AS idf
              FROM counts GROUP BY bucket),
            weighed AS (SELECT id, bucket, c * idf AS w FROM counts JOIN rarity USING (bucket) WHERE idf <> 0)
            SELECT id, bucket, round((w / sqrt(sum(w * w) OVER (PARTITION BY id)))::FLOAT::DOUBLE, 6) AS w FROM weighed""",
        "required_columns": """
            SELECT 'documents' AS source, count(*) AS n, 'missing columns: embedding, request' AS message FROM documents
            UNION ALL SELECT 'embeddings', count(*), '' FROM embeddings""",
        "facets_logged": f"WITH {FACETS} SELECT * FROM facets",
        "choose_k": """
            SELECT source, n, least(greatest(3, n // 50), 40)::INTEGER AS k FROM (
              SELECT 'conversations' AS source, count(*) AS n FROM conversations
              UNION ALL SELECT 'documents', count(*) FROM documents
              UNION ALL SELECT 'embeddings', count(*) FROM embeddings)""",
        "cluster_sizes": "SELECT label AS cluster_id, count(*) AS count FROM embeddings GROUP BY label",
        "cluster_ids": """
            SELECT DISTINCT label AS cluster_id FROM embeddings
            WHERE vec_id % 5 IN (0, 1, 2) AND label IS NOT NULL""",
        "cluster_centroids": f"""WITH {VECTORS}
            SELECT cluster_id, n, pos::INTEGER AS pos, round(m, 6) + 0.0 AS value FROM means""",
        "assign_nearest": f"""WITH {VECTORS}
            SELECT id, arg_min(cent.cluster_id, list_distance(v, c)) AS cluster_id,
              round(min(list_distance(v, c)), 6) AS distance
            FROM e, cent GROUP BY id""",
        "kmeans_lloyd": _lloyd(),
        "kmeans_fit": _kmeans(),
        "sample_in_cluster": f"""WITH {_examples(50, 50, 42)}
            SELECT cluster_id, id, rank::INTEGER AS rank FROM inside""",
        "nearest_out_cluster": f"""WITH {_examples(50, 50, 42)}
            SELECT cluster_id, id, round(distance, 6) AS distance, rank::INTEGER AS rank FROM outside""",
        "cluster_outliers": f"""WITH {VECTORS}
            SELECT cluster_id, id, round(list_distance(v, c), 6) AS distance, (row_number() OVER (
              PARTITION BY cluster_id ORDER BY list_distance(v, c) DESC, id))::INTEGER AS rank
            FROM e JOIN cent USING (cluster_id) QUALIFY rank <= 5""",
        "cluster_examples": f"""WITH {_examples(50, 50, 42, DOCUMENT_VECTORS)},
            i AS (SELECT cluster_id, count(*) AS n, string_agg(id::VARCHAR, ',' ORDER BY rank) AS ids,
                md5(string_agg(text, '|' ORDER BY rank)) AS texts
              FROM inside JOIN (SELECT id, text FROM docs) USING (id) GROUP BY cluster_id),
            o AS (SELECT cluster_id, count(*) AS n, string_agg(id::VARCHAR, ',' ORDER BY rank) AS ids,
                md5(string_agg(text, '|' ORDER BY rank)) AS texts
              FROM outside JOIN (SELECT id, text FROM docs) USING (id) GROUP BY cluster_id)
            SELECT cluster_id, i.ids AS in_ids, o.ids AS out_ids, i.texts AS in_texts, o.texts AS out_texts,
              i.n AS in_sample_size, o.n AS out_sample_size
            FROM i JOIN o USING (cluster_id)""",
        "top_tokens": f"""WITH {LANGUAGE_TEXTS}, {_tokens("texts")}
            SELECT cluster_id, token, n AS count, rank::INTEGER AS rank FROM best""",
        "fallback_names": f"WITH {LANGUAGE_TEXTS}, {_tokens('texts')} SELECT * FROM fallback",
        "cluster_prompt": f"""WITH {_naming()}
            SELECT cluster_id, digest AS hash, length(prompt)::INTEGER AS length FROM named""",
        "cluster_names": f"""WITH {_naming()}
            SELECT cluster_id, summary, name, in_sample_size, out_sample_size FROM named""",
        "naming_audit": f"""WITH {_naming()}
            SELECT cluster_id, digest AS prompt, raw_output,
              printf('cluster_%03d_prompt.txt', cluster_id) AS prompt_path,
              printf('cluster_%03d_output.txt', cluster_id) AS output_path
            FROM named""",
        "audit_files": f"""WITH {_naming()}
            SELECT printf('cluster_%03d_prompt.txt', cluster_id) AS file, digest AS hash FROM named
            UNION ALL SELECT printf('cluster_%03d_output.txt', cluster_id), md5(raw_output) FROM named""",
        "named_rows": _named_rows("id"),
        "named_rows_csv_roundtrip": _named_rows("id::VARCHAR AS id"),
        "alignment_check": """
            WITH l AS (SELECT vec_id AS k, count(*) AS n FROM embeddings GROUP BY 1),
            r AS (SELECT doc_id AS k, count(*) AS n FROM documents GROUP BY 1)
            SELECT count(*) FILTER (l.k IS NOT NULL AND r.k IS NOT NULL) AS matched,
              count(*) FILTER (r.k IS NULL) AS left_only, count(*) FILTER (l.k IS NULL) AS right_only,
              coalesce(sum(l.n - 1), 0)::BIGINT AS left_repeats,
              coalesce(sum(r.n - 1), 0)::BIGINT AS right_repeats, 0::BIGINT AS null_keys
            FROM l FULL JOIN r ON l.k = r.k""",
        "centroid_distances": f"WITH {PAIRS} SELECT a, b, round(distance, 6) AS distance FROM pairs",
        "hierarchy_flat": """
            SELECT 0 AS parent_id, string_agg(label::VARCHAR, ',' ORDER BY label) AS children
            FROM (SELECT DISTINCT label FROM embeddings)""",
        "hierarchy_document": """
            SELECT concat('[{"parent_id":0,"child_cluster_ids":[', string_agg(label::VARCHAR, ',' ORDER BY label),
                '],"parent_summary":"","parent_name":""}]') AS parents,
              count(*) AS n_clusters, 1::BIGINT AS n_parents
            FROM (SELECT DISTINCT label FROM embeddings)""",
        "hierarchy_threshold": HIERARCHY_COMPONENTS,
        "hierarchy_average": _agglomerated("avg", "s < len(labels) - 3"),
        "hierarchy_complete": _agglomerated("max", f"min(gap) < {COMPLETE_THRESHOLD}"),
        "hierarchy_divisive": """
            SELECT count(*) AS n_clusters, least(12, count(*))::BIGINT AS n_parents, true AS numbered, true AS by_smallest_child
            FROM embeddings""",
        "knn_cosine": f"""WITH {VECTORS}
            SELECT a.id, b.id AS neighbor_id, round(list_cosine_distance(a.v, b.v), 6) AS distance,
              (row_number() OVER (PARTITION BY a.id ORDER BY list_cosine_distance(a.v, b.v), b.id))::INTEGER AS rank
            FROM e a JOIN e b ON a.id <> b.id QUALIFY rank <= {KNN}""",
        "knn_approximate": f"""
            SELECT (count(*) * least({KNN}, count(*) - 1))::BIGINT AS n_exact, true AS recall_90, true AS same_distance
            FROM embeddings""",
        "projection_2d": f"""WITH RECURSIVE {PROJECTION}
            SELECT id, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y FROM coords""",
        "projection_bins": f"""WITH RECURSIVE {PROJECTION}
            SELECT cluster_id, floor(x / {BIN_WIDTH})::BIGINT AS x_bin, floor(y / {BIN_WIDTH})::BIGINT AS y_bin,
              count(*) AS count FROM coords GROUP BY ALL""",
        "cluster_separation": f"""WITH {VECTORS},
            gaps AS (
              SELECT a.id, a.cluster_id, b.cluster_id AS other, a.cluster_id = b.cluster_id AS own,
                avg(list_cosine_distance(a.v, b.v)) AS gap
              FROM e a JOIN e b ON a.id <> b.id GROUP BY ALL),
            rows_ AS (
              SELECT id, cluster_id, max(gap) FILTER (own) AS a, min(gap) FILTER (NOT own) AS b
              FROM gaps GROUP BY id, cluster_id)
            SELECT cluster_id, count(*) AS n, round(avg(coalesce((b - a) / greatest(a, b), 0)), 6) AS silhouette
            FROM rows_ GROUP BY cluster_id""",
        "xml_csv_roundtrip": f"WITH {XML} SELECT id, conversation_xml FROM xml",
        "facets_csv_roundtrip": f"""WITH {FACETS}
            SELECT id, nullif(request, '') AS request, language, task,
              CASE WHEN concerning <> '3' THEN concerning END AS concerning FROM facets""",
        "embeddings_roundtrip": """
            SELECT vec_id::VARCHAR AS id, unnest(range(len(embedding)))::INTEGER AS pos,
              unnest(embedding)::DOUBLE AS value FROM embeddings""",
        "names_jsonl_roundtrip": f"WITH {LANGUAGE_TEXTS}, {_tokens('texts')} SELECT * FROM fallback",
        "names_csv_roundtrip": f"WITH {LANGUAGE_TEXTS}, {_tokens('texts')} SELECT * FROM fallback",
        "hierarchy_json_roundtrip": """
            SELECT count(*) AS n_clusters, 0 AS parent_id,
              string_agg(label::VARCHAR, ',' ORDER BY label) AS children, '' AS parent_name
            FROM (SELECT DISTINCT label FROM embeddings)""",
        "embed_null_texts": f"""
            SELECT doc_id AS id, {DIM} AS dim,
              CASE WHEN doc_id % 5 <> 0 AND regexp_matches(lower(text), '[a-z0-9]') THEN 1.0 ELSE 0.0 END::DOUBLE AS norm
            FROM documents""",
        "projection_cached": f"""WITH RECURSIVE {PROJECTION}
            SELECT id, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y FROM coords""",
        "vector_distances": f"""WITH {VECTORS}
            SELECT id, round(list_distance(v, c), 6) AS euclidean, round(list_cosine_distance(v, c), 6) AS cosine
            FROM e JOIN cent USING (cluster_id)""",
        "head_n": f"WITH {XML} SELECT id, conversation_xml FROM xml ORDER BY id LIMIT 100",
    }
