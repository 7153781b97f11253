"""Near-duplicate documents by SimHash fingerprints and multi-index hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.llm import passages
from talkatlas.llm.columns import slices, text_bytes
from talkatlas.llm.components import star_components
from talkatlas.runtime import stored

SHINGLE_WORDS = 3
MAX_BITS = 3
# A bucket with more table entries than this is divided by the rest of the fingerprint.
BUCKET_ROWS = 2000


def fingerprint(words: list[bytes], shingle: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of the shingles of ``words``; zero where there are none."""
    import xxhash

    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    bounds = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], 42) for s, e in bounds], "<u8")
    bytes_of = hashes.view(np.uint8).reshape(-1, 8) + np.arange(8) * 256
    seen = np.bincount(bytes_of.ravel(), minlength=2048).reshape(8, 256)
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    counts = (seen @ bits).ravel()
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns in ``keep`` and ``fp``: the fingerprint of each row's ASCII-lowered text, as a signed long."""

    def run(batches):
        for part in slices(batches, "text"):
            data, offsets = text_bytes(part.column("text"))
            raw = data.tobytes()
            bounds = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
            found = np.array([fingerprint(raw[s:e].lower().split(), shingle) for s, e in bounds], np.uint64)
            names = ["doc_id", *keep]
            columns = [*(part.column(c) for c in names), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*names, "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), *keep, F.col("text").cast("string"))
    schema = T.StructType([*(rows.schema[c] for c in ("doc_id", *keep)), T.StructField("fp", T.LongType())])
    return rows.mapInArrow(run, schema)


def _half(fp: Column, segment: int) -> Column:
    return F.shiftrightunsigned(fp, 32) if segment else fp.bitwiseAND(F.lit(0xFFFFFFFF))


def _entries() -> Column:
    """The keys of a fingerprint: its own, and those with one set bit cleared, per segment.

    Of two keys that differ in one bit, clearing that bit in the one that has
    it gives the other, so this half of the Hamming ball of radius one finds
    every pair.
    """
    return F.explode(F.concat(*_segment_entries(0), *_segment_entries(1)))


def _segment_entries(segment: int) -> list[Column]:
    half, tag = _half(F.col("fp"), segment), F.lit(segment << 32).cast("long")
    bits = F.filter(F.sequence(F.lit(0), F.lit(31)), lambda i: F.getbit(half, i) == 1)
    near = F.transform(bits, lambda i: half - F.call_function("shiftleft", F.lit(1).cast("long"), i))
    own = F.array(F.struct((half + tag).alias("bucket"), F.lit(True).alias("own")))
    return [own, F.transform(near, lambda k: F.struct((k + tag).alias("bucket"), F.lit(False).alias("own")))]


def _divided(rows: DataFrame) -> DataFrame:
    """Rows of full buckets by the four bytes of the other segment as well.

    At most ``MAX_BITS`` of its bits differ, so one of the four bytes is equal.
    """
    other = F.when(F.col("bucket") < (1 << 32), _half(F.col("fp"), 1)).otherwise(_half(F.col("fp"), 0))
    parts = [
        (F.lit(1 + (i << 8)) + F.shiftrightunsigned(other, 8 * i).bitwiseAND(F.lit(255))).cast("int") for i in range(4)
    ]
    return rows.withColumn("part", F.explode(F.array(*parts)))


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union the groups of the row pairs (a, b) in ``labels``."""
    while len(a):
        low = np.minimum(labels[a], labels[b])
        np.minimum.at(labels, labels[a], low)
        np.minimum.at(labels, labels[b], low)
        while not np.array_equal(labels, again := labels[labels]):
            labels[:] = again
        rest = labels[a] != labels[b]
        a, b = a[rest], b[rest]


def _linked(bucket: np.ndarray, fp: np.ndarray, own: np.ndarray, max_bits: int):
    """Links within the buckets of sorted rows, one per row that has a smaller partner."""
    labels = np.arange(len(fp))
    step, rows = 1, np.arange(len(fp) - 1)
    while len(rows):
        rows = rows[bucket[rows + step] == bucket[rows]]
        far = rows + step
        near = (own[rows] | own[far]) & (np.bitwise_count(fp[rows] ^ fp[far]) <= max_bits) & (labels[rows] != labels[far])
        _merge(labels, rows[near], far[near])
        step += 1
        rows = rows[rows + step < len(fp)]
    moved = np.flatnonzero(labels != np.arange(len(fp)))
    return fp[moved], fp[labels[moved]]


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``a, b``: links that connect all distinct fingerprints ``fp`` within ``max_bits`` bits.

    ``max_bits`` is at most 3: then one of the two segments of 32 bits differs
    in at most one bit.  All pairs of a bucket are verified, but only a tree of
    links per bucket leaves the task.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits has to be between 0 and 3")
    rows = prints.select("fp", _entries().alias("e")).select("e.bucket", "e.own", "fp")
    rows = rows.withColumn("part", F.lit(0))
    own = prints.select(F.explode(F.array(_half(F.col("fp"), 0), _half(F.col("fp"), 1) + F.lit(1 << 32))).alias("bucket"))
    full = stored(own.groupBy("bucket").count().where(F.col("count") > BUCKET_ROWS).select("bucket"))
    if not full.isEmpty():
        marked = rows.join(full.withColumn("full", F.lit(True)), "bucket", "left")
        rest = marked.where("full IS NULL").select(*rows.columns)
        rows = rest.unionByName(_divided(marked.where("full").select(*rows.columns)))

    def run(batches):
        held = []

        def flush(parts):
            table = pa.Table.from_batches(parts)
            bucket, part, fp = (table.column(c).to_numpy() for c in ("bucket", "part", "fp"))
            own = table.column("own").to_numpy()
            group = np.cumsum(np.concatenate([[0], (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])]))
            a, b = _linked(group, fp.view(np.uint64), own, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        def last_group(batch):
            """Where the last bucket of the batch begins."""
            bucket, part = batch.column("bucket").to_numpy(), batch.column("part").to_numpy()
            other = np.flatnonzero((bucket != bucket[-1]) | (part != part[-1]))
            return int(other[-1]) + 1 if len(other) else 0

        for batch in batches:
            if not len(batch):
                continue
            first = held and all(held[-1].column(c)[-1] == batch.column(c)[0] for c in ("bucket", "part"))
            cut = last_group(batch)
            if cut or (held and not first):
                yield flush([*held, batch.slice(0, cut)] if cut else held)
                held = []
            held.append(batch.slice(cut))
        if held:
            yield flush(held)

    return rows.repartition("bucket", "part").sortWithinPartitions("bucket", "part").mapInArrow(run, "a long, b long")


def _rooted(nodes: DataFrame, max_bits: int) -> DataFrame:
    """``nodes(fp, ...)`` with the ``root`` fingerprint of the group of each."""
    roots = star_components(links(nodes, max_bits)).withColumnRenamed("node", "fp")
    return nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs(doc_id, text, ...)``.

    Fingerprints within ``max_bits`` bits are linked; ``component_id`` is the
    smallest ``doc_id`` reachable.  Equal fingerprints are looked up once, and a
    group of copies enters as one node.

    Null and empty texts, and texts of white space, have fingerprint zero and
    link like any other.  Repeated rows give repeated rows.  A null ``doc_id``
    stays null and never names a component, unless no other id is there; other
    columns are not read.  An empty table gives an empty result.
    """
    prints = stored(fingerprints(docs, shingle))
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    joined = _rooted(nodes, max_bits)
    least = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(joined.join(least, "root").select("fp", "component_id"))
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each near-duplicate group, the one of the smallest ``doc_id``.

    Of rows that share that id, one of the smallest text hash stays; a row
    without an id stays only where no row of its group has one.  Null and empty
    texts are near-duplicates of each other, as in ``near_duplicates``.
    """
    prints = fingerprints(passages.with_tag(docs), shingle, keep=("tag",))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tag")).alias("first")
    # Copies meet as one row per task and fingerprint.
    nodes = stored(prints.groupBy("fp").agg(first))
    chosen = _rooted(nodes, max_bits).groupBy("root").agg(F.min("first").alias("first"))
    key = F.struct("first.doc_id", "first.tag").alias("key")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = F.struct(F.col("doc_id").cast("long").alias("doc_id"), passages.tag_of(text).alias("tag"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), own.alias("key"))
    kept = rows.join(chosen.select(key), "key", "left_semi").dropDuplicates(["key"])
    return kept.select(*(F.col("row")[c].alias(c) for c in docs.columns))
