"""Every operator as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkatlas.checks import alignment_report, require_columns
from talkatlas.functions import text, vectors
from talkatlas.operators import (
    cluster,
    embed,
    examples,
    facets,
    hierarchy,
    naming,
    neighbors,
    prepare,
    project,
)
from talkatlas.params import HierarchyParams, NamingParams, ProjectionParams
from talkatlas.plans.stubs import stub_facet_completer, stub_naming_completer
from talkatlas.runtime import join_small, shared_dir, stored
from talkatlas.sources import tables

LLOYD_STEPS = 5
# Enough for the SQL twin to spell out; the default of the fit is to go on until centroids rest.
KMEANS_STEPS = 8
THRESHOLD = 0.8
COMPLETE_THRESHOLD = 0.95
KNN = 10
BIN_WIDTH = 0.1
DIM = 64
LANGUAGES = ("de", "en", "es", "fr")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turn table as raw records with base64 JSON content, one per conversation."""
    turns = _table(spark, sf_dir, "conversations")
    turn = F.struct("turn", "role", "text")
    folded = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    bare = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    content = F.to_json(F.struct(bare.alias("turns")))
    day = F.lpad((F.col("conv_id") % 28 + 1).cast("string"), 2, "0")
    return folded.select(
        F.col("conv_id").cast("string").alias("id"),
        F.concat(F.lit("2025-01-"), day, F.lit("T00:00")).alias("created_dttm"),
        F.when(F.col("conv_id") % 3 != 0, F.concat(F.lit('Q&A "'), "conv_id", F.lit('"'))).alias("title"),
        F.lit("chat").alias("tags"),
        F.base64(F.encode(content, "UTF-8")).alias("encoded_content"),
    )


def _documents_xml(spark, sf_dir):
    return prepare.conversation_documents(raw_conversations(spark, sf_dir))


def _vectors(spark, sf_dir):
    return _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").alias("cluster_id"), "embedding"
    )


def _texts(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("request")
    )


def _language_number():
    found = F.array_position(F.lit(list(LANGUAGES)), F.col("lang"))
    return F.coalesce(found, F.lit(0)).cast("int").alias("cluster_id")


def _rows(spark, sf_dir):
    """All documents with a hash embedding, clustered by language."""
    docs = _table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("request"), _language_number()
    )
    return stored(embed.embed(docs, embed.hashing_encoder(DIM), keep=("request", "cluster_id")))


def _by_language(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select(
        _language_number(), F.col("doc_id").alias("rank"), "text"
    )


def _long(df: DataFrame, *keys: str) -> DataFrame:
    """One row per centroid component, rounded for comparison."""
    return df.select(*keys, F.posexplode("centroid").alias("pos", "v")).select(
        *keys, "pos", _rounded("v").alias("value")
    )


def _rounded(name: str):
    # Adding zero turns a negative zero into zero.
    return F.round(F.col(name), 6) + F.lit(0.0)


def decode_turns(spark, sf_dir):
    turns = prepare.add_turns(raw_conversations(spark, sf_dir))
    return turns.select("id", F.posexplode("turns").alias("place", "t")).select(
        "id", "place", F.col("t.role").alias("role"), F.col("t.text").alias("text")
    )


def decode_bad_input(spark, sf_dir):
    """Damaged records, one kind of damage per remainder of the id."""
    turn = F.struct(F.lit("user").alias("role"), F.concat(F.lit("Oh, "), "text").alias("text"))
    payload = F.to_json(F.struct(F.array(turn).alias("turns")))
    # Spaces at the end bring all lengths to one remainder, so that all need padding.
    payload = F.concat(payload, F.repeat(F.lit(" "), F.pmod(1 - F.octet_length(payload), F.lit(3)).cast("int")))
    plain = F.regexp_replace(F.base64(payload.cast("binary")), "\\s", "")
    bad_bytes = F.concat(F.unhex(F.lit("FF")), payload.cast("binary"))
    kinds = [
        F.rtrim(plain, F.lit("=")),
        F.concat(F.lit(" \n"), F.substring(plain, 1, 9), F.lit("!\n*"), F.substr(plain, F.lit(10))),
        F.base64(bad_bytes),
        F.base64(F.concat(payload, F.lit(" junk")).cast("binary")),
        F.base64(F.concat(F.lit("["), payload, F.lit("]")).cast("binary")),
        F.concat(plain, F.lit("é")),
        F.lit(None).cast("string"),
        F.concat(F.substring(plain, 1, 2), F.lit("="), F.substr(plain, F.lit(3))),
        F.concat(plain, F.lit("QUJD")),
        plain,
        F.base64(F.concat(payload, F.lit("]")).cast("binary")),
        F.base64(F.concat(payload, F.lit("}] junk")).cast("binary")),
    ]
    # One branch is worked out per row, not all of them.
    encoded = F.when(F.col("doc_id") % len(kinds) == 0, kinds[0])
    for i, damaged in enumerate(kinds[1:], 1):
        encoded = encoded.when(F.col("doc_id") % len(kinds) == i, damaged)
    decoded = text.decode_turns(encoded)
    return _table(spark, sf_dir, "documents").select(
        "doc_id", F.size(decoded).alias("n"), F.get(decoded, F.lit(0))["text"].alias("text")
    )


def conversation_xml(spark, sf_dir):
    return _documents_xml(spark, sf_dir)


def xml_escape_pages(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", text.xml_escape(F.col("html")).alias("escaped"))


def facets_batched(spark, sf_dir):
    return facets.extract_facets(_documents_xml(spark, sf_dir), stub_facet_completer)


def facets_sequential(spark, sf_dir):
    return facets.extract_facets_one_by_one(_documents_xml(spark, sf_dir), stub_facet_completer)


def raw_csv_roundtrip(spark, sf_dir):
    """Raw records written as CSV, read back and decoded."""
    path = f"{shared_dir(spark)}/raw-{uuid.uuid4().hex}"
    tables.write_csv(raw_conversations(spark, sf_dir), path)
    decoded = prepare.add_turns(tables.read_raw_conversations(spark, path, one_line=True))
    return decoded.select("id", "created_dttm", "title", "tags", F.size("turns").alias("n_turns"))


def concern_histogram(spark, sf_dir):
    scored = facets.with_concern_score(facets_batched(spark, sf_dir))
    return scored.groupBy("concern_score").agg(F.count("*").alias("count"))


def facet_prompts(spark, sf_dir):
    """Both kinds of prompt, compared by hash and length."""
    xml = F.col("conversation_xml")
    kinds = [("batched", facets.batched_prompt(xml))]
    kinds += [(s.key, facets.facet_prompt(xml, s)) for s in facets.FACET_SPECS]
    listed = F.explode(
        F.array(*[F.struct(F.lit(k).alias("kind"), p.alias("prompt")) for k, p in kinds])
    )
    return (
        _documents_xml(spark, sf_dir)
        .select("id", listed.alias("p"))
        .select("id", "p.kind", F.md5("p.prompt").alias("hash"), F.length("p.prompt").cast("bigint").alias("length"))
    )


def facet_tags_parse(spark, sf_dir):
    """Tags of mixed case, repeated, spread over lines or missing."""
    docs = _table(spark, sf_dir, "documents")
    answer = F.concat(
        F.lit("Sure:\n<Request>\n "),
        "text",
        F.lit(" \t</REQUEST><request>later</request>"),
        F.when(F.col("doc_id") % 3 == 0, F.lit("<language>English")).otherwise(
            F.concat(F.lit("<language> "), "lang", F.lit(" </language>"))
        ),
        F.when(F.col("doc_id") % 2 == 0, F.lit("<task></task>")).otherwise(F.lit("<TASK>do\nit</TASK>")),
        F.lit("<concerning>"),
        (F.col("doc_id") % 8).cast("string"),
        F.lit("</concerning><answer> "),
        "source",
        F.lit("\n</answer>"),
    )
    answer = F.when(F.col("doc_id") % 11 != 0, answer)
    parsed = docs.select(
        "doc_id", *facets.parse_facets(answer), text.tag_text(answer, "answer").alias("answer")
    )
    return facets.with_concern_score(parsed)


def hash_embed(spark, sf_dir):
    embedded = embed.embed(_texts(spark, sf_dir), embed.hashing_encoder(DIM))
    parts = embedded.select("id", F.posexplode("embedding").alias("bucket", "w")).where("w <> 0")
    return parts.select("id", "bucket", F.round(F.col("w").cast("double"), 6).alias("w"))


def choose_k(spark, sf_dir):
    names = ("conversations", "documents", "embeddings")
    counts = [
        _table(spark, sf_dir, n).agg(F.lit(n).alias("source"), F.count("*").alias("n")) for n in names
    ]
    every = counts[0].unionByName(counts[1]).unionByName(counts[2])
    return every.select("source", "n", cluster.choose_k_expr(F.col("n")).alias("k"))


def cluster_sizes(spark, sf_dir):
    return cluster.cluster_sizes(_vectors(spark, sf_dir))


def cluster_ids(spark, sf_dir):
    """Distinct labels from text labels, some of them unusable."""
    label = F.col("cluster_id").cast("string")
    damaged = (
        F.when(F.col("id") % 5 == 0, label)
        .when(F.col("id") % 5 == 1, F.concat(label, F.lit(".0")))
        .when(F.col("id") % 5 == 2, F.concat(F.lit(" "), label, F.lit(" ")))
        .when(F.col("id") % 5 == 3, F.concat(F.lit("no "), label))
    )
    return cluster.cluster_ids(_vectors(spark, sf_dir).withColumn("cluster_id", damaged))


def cluster_centroids(spark, sf_dir):
    return _long(cluster.centroids(_vectors(spark, sf_dir)), "cluster_id", "n")


def assign_nearest(spark, sf_dir):
    rows = _vectors(spark, sf_dir)
    nearest = cluster.assign_nearest(rows, cluster.centroids(rows))
    return nearest.select("id", "cluster_id", _rounded("distance").alias("distance"))


def _start_points(rows, k):
    """``k`` rows drawn by a hash of their id, as numbered start centroids."""
    start = rows.orderBy(F.md5(F.col("id").cast("string")), "id").limit(k)
    start = start.select(F.md5(F.col("id").cast("string")).alias("draw"), "embedding")
    listed = start.agg(F.array_sort(F.collect_list(F.struct("draw", "embedding"))).alias("s"))
    return listed.select(F.posexplode("s").alias("cluster_id", "p")).select(
        "cluster_id", F.col("p.embedding").alias("centroid")
    )


def kmeans_lloyd(spark, sf_dir):
    rows = _vectors(spark, sf_dir)
    start = _start_points(rows, cluster.choose_k(rows.count()))
    return _long(cluster.lloyd(rows, start, LLOYD_STEPS), "cluster_id", "n")


def kmeans_fit(spark, sf_dir):
    """Labels of a whole k-means run, start points included."""
    rows = _vectors(spark, sf_dir).drop("cluster_id")
    return cluster.fit_kmeans(rows, max_iter=KMEANS_STEPS, tol=0.0)[0]


def sample_in_cluster(spark, sf_dir):
    return examples.sample_in_cluster(_vectors(spark, sf_dir))


def nearest_out_cluster(spark, sf_dir):
    rows = _vectors(spark, sf_dir)
    found = examples.nearest_outside(rows, cluster.centroids(rows))
    return found.withColumn("distance", _rounded("distance"))


def cluster_outliers(spark, sf_dir):
    rows = _vectors(spark, sf_dir)
    found = examples.farthest_inside(rows, cluster.centroids(rows))
    return found.withColumn("distance", _rounded("distance"))


def _joined(name: str):
    return F.array_join(F.transform(name, lambda i: i.cast("string")), ",").alias(name)


def cluster_examples(spark, sf_dir):
    bundles = examples.example_bundles(_rows(spark, sf_dir))
    return bundles.select(
        "cluster_id",
        _joined("in_ids"),
        _joined("out_ids"),
        F.md5(F.array_join("in_texts", "|")).alias("in_texts"),
        F.md5(F.array_join("out_texts", "|")).alias("out_texts"),
        "in_sample_size",
        "out_sample_size",
    )


def top_tokens(spark, sf_dir):
    return naming.top_tokens(_by_language(spark, sf_dir))


def fallback_names(spark, sf_dir):
    return naming.fallback_names(_by_language(spark, sf_dir))


def _named(spark, sf_dir):
    params = NamingParams(in_cluster_n=20, out_cluster_n=10, random_state=123)
    return naming.name_clusters(_rows(spark, sf_dir), stub_naming_completer, params)


def cluster_prompt(spark, sf_dir):
    return _named(spark, sf_dir).select(
        "cluster_id", F.md5("prompt").alias("hash"), F.length("prompt").alias("length")
    )


def cluster_names(spark, sf_dir):
    return _named(spark, sf_dir).select(
        "cluster_id", "summary", "name", "in_sample_size", "out_sample_size"
    )


def naming_audit(spark, sf_dir):
    audit = naming.audit_table(_named(spark, sf_dir))
    return audit.withColumn("prompt", F.md5("prompt"))


def named_rows(spark, sf_dir):
    """Names exist for even clusters only; the other rows keep nulls."""
    words = _by_language(spark, sf_dir)
    names = naming.fallback_names(words.where(F.col("cluster_id") % 2 == 0))
    return naming.attach_names(words.select(F.col("rank").alias("id"), "cluster_id"), stored(names))


def named_rows_csv_roundtrip(spark, sf_dir):
    """Named rows as CSV; a row without a name comes back with nulls."""
    path = f"{shared_dir(spark)}/named-{uuid.uuid4().hex}"
    facet = [F.lit(c).alias(c) for c in ("request", "language", "task", "concerning")]
    rows = named_rows(spark, sf_dir).select(F.col("id").cast("string").alias("id"), *facet, "cluster_id", "summary", "name")
    tables.write_csv(rows, path)
    return tables.read_named_rows_csv(spark, path).select("id", "cluster_id", "summary", "name")


def audit_files(spark, sf_dir):
    """Prompts and answers as text files, found again by their names."""
    path = f"{shared_dir(spark)}/audit-{uuid.uuid4().hex}"
    tables.write_audit_texts(_named(spark, sf_dir), path)
    found = spark.read.text(path, wholetext=True)
    return found.select(F.col("_metadata.file_name").alias("file"), F.md5("value").alias("hash"))


def facets_logged(spark, sf_dir):
    """Half of the prompts are answered in a first run, the rest in a second."""
    log = f"{shared_dir(spark)}/answers-{uuid.uuid4().hex}"
    docs = _documents_xml(spark, sf_dir)
    facets.extract_facets(docs.where(F.col("id").cast("long") % 2 == 0), stub_facet_completer, log_path=log)
    return facets.extract_facets(docs, stub_facet_completer, log_path=log)


def facets_sequential_logged(spark, sf_dir):
    """Four calls per row; those of a third of the rows are answered in a run before."""
    log = f"{shared_dir(spark)}/answers-{uuid.uuid4().hex}"
    docs = _documents_xml(spark, sf_dir)
    facets.extract_facets_one_by_one(docs.where(F.col("id").cast("long") % 3 == 0), stub_facet_completer, log_path=log)
    return facets.extract_facets_one_by_one(docs, stub_facet_completer, log_path=log)


def idf_embed(spark, sf_dir):
    rows = _texts(spark, sf_dir)
    embedded = embed.fit_idf_encoder(rows, DIM)(rows)
    parts = embedded.select("id", F.posexplode("embedding").alias("bucket", "w")).where("w <> 0")
    return parts.select("id", "bucket", F.round(F.col("w").cast("double"), 6).alias("w"))


def required_columns(spark, sf_dir):
    """What the column check says of tables that lack some."""
    found = None
    for name, asked in (("documents", ("doc_id", "request", "embedding")), ("embeddings", ("vec_id", "label"))):
        table, message = _table(spark, sf_dir, name), ""
        try:
            require_columns(table, *asked)
        except ValueError as lacking:
            message = str(lacking)
        row = table.agg(F.lit(name).alias("source"), F.count("*").alias("n"), F.lit(message).alias("message"))
        found = row if found is None else found.unionByName(row)
    return found


def alignment_check(spark, sf_dir):
    return alignment_report(_vectors(spark, sf_dir), _texts(spark, sf_dir))


def centroid_distances(spark, sf_dir):
    pairs = hierarchy.centroid_distances(cluster.centroids(_vectors(spark, sf_dir)))
    return pairs.select("a", "b", _rounded("distance").alias("distance"))


def _children(groups):
    table = hierarchy.hierarchy_table(groups)
    return table.select("parent_id", F.array_join("child_cluster_ids", ",").alias("children"))


def hierarchy_flat(spark, sf_dir):
    return _children(hierarchy.group_clusters(cluster.centroids(_vectors(spark, sf_dir))))


def hierarchy_document(spark, sf_dir):
    doc = hierarchy.build_hierarchy(_vectors(spark, sf_dir))
    return doc.select(F.to_json("parents").alias("parents"), "meta.n_clusters", "meta.n_parents")


def hierarchy_threshold(spark, sf_dir):
    params = HierarchyParams(distance_threshold=THRESHOLD, linkage="single")
    return _children(hierarchy.group_clusters(cluster.centroids(_vectors(spark, sf_dir)), params))


def hierarchy_average(spark, sf_dir):
    params = HierarchyParams(n_parents=3)
    return _children(hierarchy.group_clusters(cluster.centroids(_vectors(spark, sf_dir)), params))


def hierarchy_complete(spark, sf_dir):
    params = HierarchyParams(distance_threshold=COMPLETE_THRESHOLD, linkage="complete")
    return _children(hierarchy.group_clusters(cluster.centroids(_vectors(spark, sf_dir)), params))


def hierarchy_divisive(spark, sf_dir):
    """What holds for any tree that is split from the top.

    Rows are their own clusters here, so that there are many of them.
    """
    points = _vectors(spark, sf_dir).select(F.col("id").cast("int").alias("cluster_id"), F.col("embedding").alias("centroid"))
    groups = stored(hierarchy.group_clusters(points, HierarchyParams(n_parents=12, linkage="divisive")))
    parents = groups.groupBy("parent_id").agg(F.count("*").alias("n"), F.min("cluster_id").alias("first"))
    by_parent = F.array_sort(F.collect_list(F.struct("parent_id", "first")))
    firsts = F.transform(by_parent, lambda p: p["first"])
    return parents.agg(
        F.sum("n").alias("n_clusters"),
        F.count("*").alias("n_parents"),
        (F.max("parent_id") + 1 == F.count("*")).alias("numbered"),
        (firsts == F.array_sort(firsts)).alias("by_smallest_child"),
    )


def knn_cosine(spark, sf_dir):
    found = neighbors.nearest_neighbors(_vectors(spark, sf_dir), KNN)
    return found.withColumn("distance", _rounded("distance"))


def knn_approximate(spark, sf_dir):
    """How much of the exact lists the bucketed search finds, and whether distances are right."""
    rows = _vectors(spark, sf_dir).select("id", "embedding")
    exact = stored(neighbors.nearest_neighbors(rows, KNN))
    found = stored(neighbors.approximate_neighbors(rows, KNN, tables=16))
    both = exact.join(found.select("id", "neighbor_id", F.col("distance").alias("near")), ["id", "neighbor_id"], "left")
    off = F.coalesce(F.max(F.abs(F.col("near") - F.col("distance"))), F.lit(0.0))
    sums = both.agg(F.count("*").alias("n_exact"), F.count("near").alias("n_found"), off.alias("off"))
    return sums.select(
        "n_exact",
        (F.col("n_found") >= 0.9 * F.col("n_exact")).alias("recall_90"),
        (F.col("off") < 1e-9).alias("same_distance"),
    )


def projection_2d(spark, sf_dir):
    rows = _vectors(spark, sf_dir).select("id", "embedding")
    return project.project_and_merge(rows).select("id", _rounded("x").alias("x"), _rounded("y").alias("y"))


def projection_bins(spark, sf_dir):
    projected = project.project_and_merge(_vectors(spark, sf_dir), ProjectionParams(n_neighbors=5))
    return project.projection_bins(projected, BIN_WIDTH)


def cluster_separation(spark, sf_dir):
    scores = project.silhouette(_vectors(spark, sf_dir))
    return scores.select("cluster_id", "n", _rounded("silhouette").alias("silhouette"))


def xml_csv_roundtrip(spark, sf_dir):
    path = f"{shared_dir(spark)}/xml-{uuid.uuid4().hex}"
    tables.write_csv(_documents_xml(spark, sf_dir), path)
    return tables.read_conversation_xml_csv(spark, path)


def facets_csv_roundtrip(spark, sf_dir):
    """Empty texts come back as nulls."""
    path = f"{shared_dir(spark)}/facets-{uuid.uuid4().hex}"
    blank = F.when(F.col("concerning") != "3", F.col("concerning")).otherwise(F.lit(""))
    tables.write_csv(facets_batched(spark, sf_dir).withColumn("concerning", blank), path)
    return tables.read_facets_csv(spark, path)


def embeddings_roundtrip(spark, sf_dir):
    rows = _vectors(spark, sf_dir).select(F.col("id").cast("string").alias("id"), "embedding")
    path = f"{shared_dir(spark)}/embeddings-{uuid.uuid4().hex}"
    tables.write_table(rows, path)
    stored_rows = tables.read_embeddings(spark, path)
    values = stored_rows.select("id", F.posexplode("embedding").alias("pos", "value"))
    return values.withColumn("value", F.col("value").cast("double"))


def names_jsonl_roundtrip(spark, sf_dir):
    path = f"{shared_dir(spark)}/names-{uuid.uuid4().hex}"
    tables.write_cluster_names(fallback_names(spark, sf_dir), f"{path}-csv", f"{path}-jsonl")
    return tables.read_cluster_names(spark, f"{path}-jsonl")


def names_csv_roundtrip(spark, sf_dir):
    path = f"{shared_dir(spark)}/names-{uuid.uuid4().hex}"
    tables.write_cluster_names(fallback_names(spark, sf_dir), f"{path}-csv", f"{path}-jsonl")
    return tables.read_cluster_names_csv(spark, f"{path}-csv")


def hierarchy_json_roundtrip(spark, sf_dir):
    """The hierarchy document as a file, one row per parent."""
    path = f"{shared_dir(spark)}/hierarchy-{uuid.uuid4().hex}"
    tables.write_hierarchy(hierarchy.build_hierarchy(_vectors(spark, sf_dir)), path)
    parents = tables.read_hierarchy(spark, path).select("meta.n_clusters", F.explode("parents").alias("p"))
    children = F.array_join("p.child_cluster_ids", ",").alias("children")
    return parents.select("n_clusters", "p.parent_id", children, "p.parent_name")


def embed_null_texts(spark, sf_dir):
    """A missing text is embedded like an empty one, as the zero vector."""
    text_or_null = F.when(F.col("id") % 5 != 0, F.col("request")).alias("request")
    rows = _texts(spark, sf_dir).select("id", text_or_null)
    embedded = embed.embed(rows, embed.hashing_encoder(DIM))
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    return embedded.select("id", F.size("embedding").alias("dim"), F.round(norm, 3).alias("norm"))


def projection_cached(spark, sf_dir):
    """The second call reads what the first has stored."""
    rows = _vectors(spark, sf_dir).select("id", "embedding")
    folder = f"{shared_dir(spark)}/projection-{uuid.uuid4().hex}"
    project.cached_projection(rows, ProjectionParams(), folder)
    merged = project.project_and_merge(rows, cache_dir=folder)
    return merged.select("id", _rounded("x").alias("x"), _rounded("y").alias("y"))


def vector_distances(spark, sf_dir):
    """The distance expressions, between each row and the centroid of its cluster."""
    rows = _vectors(spark, sf_dir)
    points = stored(cluster.centroids(rows)).drop("n")
    joined = join_small(rows, points, "cluster_id", "inner")
    pair = (F.col("embedding"), F.col("centroid"))
    return joined.select(
        "id",
        F.round(vectors.euclidean(*pair), 6).alias("euclidean"),
        F.round(vectors.cosine_distance(*pair), 6).alias("cosine"),
    )


def head_n(spark, sf_dir):
    """The records are cut first, and only those that are left are decoded."""
    first = prepare.first_rows(raw_conversations(spark, sf_dir), 100)
    return prepare.conversation_documents(first).select("id", "conversation_xml")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations to named clusters: every stage once, no join by id."""
    found = facets_batched(spark, sf_dir)
    kept = [c for c in found.columns if c != "id"]
    embedded = stored(embed.embed(found, embed.hashing_encoder(DIM), keep=kept))
    k = cluster.choose_k(embedded.count())
    points = cluster.lloyd(embedded, _start_points(embedded, k), LLOYD_STEPS)
    rows = stored(cluster.assign_nearest(embedded, points, keep_vector=True, keep=kept))
    names = naming.name_clusters(rows, stub_naming_completer, NamingParams(in_cluster_n=20, out_cluster_n=10, random_state=123))
    named = naming.attach_names(rows, stored(names), bound=k)
    return named.select(*found.columns, "cluster_id", "summary", "name")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        decode_turns,
        decode_bad_input,
        conversation_xml,
        xml_escape_pages,
        facets_batched,
        facets_sequential,
        raw_csv_roundtrip,
        concern_histogram,
        facet_prompts,
        facet_tags_parse,
        hash_embed,
        choose_k,
        cluster_sizes,
        cluster_ids,
        cluster_centroids,
        assign_nearest,
        kmeans_lloyd,
        kmeans_fit,
        sample_in_cluster,
        nearest_out_cluster,
        cluster_outliers,
        cluster_examples,
        top_tokens,
        fallback_names,
        cluster_prompt,
        cluster_names,
        naming_audit,
        audit_files,
        facets_logged,
        facets_sequential_logged,
        idf_embed,
        required_columns,
        named_rows,
        named_rows_csv_roundtrip,
        alignment_check,
        centroid_distances,
        hierarchy_flat,
        hierarchy_document,
        hierarchy_threshold,
        hierarchy_average,
        hierarchy_complete,
        hierarchy_divisive,
        knn_cosine,
        knn_approximate,
        projection_2d,
        projection_bins,
        cluster_separation,
        xml_csv_roundtrip,
        facets_csv_roundtrip,
        embeddings_roundtrip,
        names_jsonl_roundtrip,
        names_csv_roundtrip,
        hierarchy_json_roundtrip,
        embed_null_texts,
        projection_cached,
        vector_distances,
        head_n,
        flagship,
    )
}
