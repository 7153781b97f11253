"""Removal of repeated byte strings, by sorted suffixes at sampled anchors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.llm import passages
from talkatlas.llm.columns import Powers, byte_codes, slices, text_bytes
from talkatlas.runtime import discard, stored

WINDOW = 100
GRAM = 24
# Bytes of one bucket.  An anchor stays in one bucket, so this is a lower bound where one is larger.
BUCKET_BYTES = 4 << 20
# An anchor with more different passages than this is compared window by window.
ANCHOR_PASSAGES = 2_000


def _bytes(column: pa.Array, powers: Powers):
    data, offsets = text_bytes(column)
    return byte_codes()[data], offsets


def _bounds(column: pa.Array):
    data, _ = text_bytes(column)
    at = np.arange(len(data) + 1)
    return data, at[:-1], at[1:]


def _tokens(data: np.ndarray, pad: int) -> np.ndarray:
    """At each byte, the next eight bytes as one number that sorts like them."""
    data = np.concatenate([data, np.zeros(pad + 8, np.uint8)]).astype(np.uint64)
    size = len(data) - 8
    tokens = np.zeros(size, np.uint64)
    for i in range(8):
        tokens = (tokens << np.uint64(8)) | data[i : i + size]
    return tokens


def multikey_sort(tokens: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The order of the suffixes that start ``at``, by their first ``depth`` bytes or some more.

    Each round sorts by one token of eight bytes, and goes on with the next
    token only within the groups that are still tied.
    """
    order = np.argsort(tokens[at], kind="stable")
    along = tokens[at[order]]
    group = np.cumsum(np.concatenate([[0], along[1:] != along[:-1]])) if len(at) else order
    places = np.arange(len(at))
    for skip in range(8, depth, 8):
        size = np.bincount(group, minlength=1)
        tied = size[group] > 1
        places, group = places[tied], group[tied]
        if not len(places):
            break
        token = tokens[at[order[places]] + skip]
        again = np.lexsort((token, group))
        order[places] = order[places[again]]
        token, group = token[again], group[again]
        group = np.cumsum(np.concatenate([[0], (group[1:] != group[:-1]) | (token[1:] != token[:-1])]))
    return order


def common_prefixes(tokens: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """For neighbours in a sorted list of suffixes, the bytes they share, up to ``depth`` or some more."""
    shared = np.zeros(max(len(at) - 1, 0), np.int64)
    live = np.arange(len(shared))
    for skip in range(0, depth, 8):
        apart = tokens[at[live] + skip] ^ tokens[at[live + 1] + skip]
        equal = np.full(len(live), 8)
        for i in range(8):
            equal[(apart >> np.uint64(8 * i)) > 0] = 7 - i
        shared[live] += equal
        live = live[equal == 8]
    return shared


def _groups(shared: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """A number per suffix, equal where the first ``depth`` bytes are."""
    number = np.zeros(len(order), np.int64)
    number[order[1:]] = np.cumsum(shared < depth)
    return number


def later_windows(data, begin, anchor, count, window: int, gram: int) -> np.ndarray:
    """Flags, one row per passage and one column per window, of windows that also start earlier.

    Passages come in the order of their places.  The suffixes that start at the
    anchors are sorted, and so are the reversed prefixes that end there.  Two
    windows are equal if their anchors have the same offset in them, and both
    parts are in equal groups at the depths that the offset gives.
    """
    width = window - gram + 1
    right, left = _tokens(data, window + 8), _tokens(data[::-1], window + 8)
    back = len(data) - anchor
    by_right = multikey_sort(right, anchor, window)
    by_left = multikey_sort(left, back, width)
    shared_right = common_prefixes(right, anchor[by_right], window)
    shared_left = common_prefixes(left, back[by_left], width)
    flags = np.zeros((len(begin), width), bool)
    offset = anchor - begin
    for place in range(width):
        rows = np.flatnonzero((place <= offset) & (place > offset - count))
        if len(rows) < 2:
            continue
        key = _groups(shared_right, by_right, window - place)[rows] * (len(begin) + 1)
        key += _groups(shared_left, by_left, place)[rows]
        _, first = np.unique(key, return_index=True)
        flags[rows, offset[rows] - place] = True
        flags[rows[first], offset[rows[first]] - place] = False
    return flags


def _sorted_buckets(window: int, gram: int):
    """Range-partitioned passages to ``anchor, passage, spans``, one sorted bucket at a time."""

    def bucket(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        table = table.append_column("unnamed", pc.is_null(table.column("doc_id")))
        for part in ("x", "y"):
            table = table.append_column(part, pc.struct_field(table.column("tag"), part))
        table = table.drop_columns(["tag"])
        reach = pc.add(table.column("start"), table.column("offset").cast(pa.int64()))
        table = table.append_column("reach", reach).sort_by(
            [("unnamed", "ascending"), ("doc_id", "ascending"), ("reach", "ascending"), ("x", "ascending"), ("y", "ascending")]
        )
        table = table.combine_chunks()
        data, offsets = text_bytes_of(table.column("body"))
        begin = offsets[:-1]
        anchor = begin + table.column("offset").to_numpy()
        count = np.diff(offsets) - window + 1
        flags = later_windows(data, begin, anchor, count, window, gram)
        hit = np.flatnonzero(flags.any(axis=1))
        found = table.select(["anchor", "passage"]).take(pa.array(hit))
        lists = pa.array([passages.runs(flags[i], window) for i in hit], pa.list_(pa.int32()))
        columns = [found.column(c).combine_chunks() for c in ("anchor", "passage")]
        return pa.RecordBatch.from_arrays([*columns, lists], ["anchor", "passage", "spans"])

    def text_bytes_of(column: pa.ChunkedArray):
        array = column.combine_chunks()
        if isinstance(array, pa.ChunkedArray):
            array = array.chunk(0) if array.num_chunks else pa.array([], pa.binary())
        _, offsets, data = array.buffers()
        offsets = np.frombuffer(offsets, np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
        return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]

    def run(batches):
        held, size = [], 0
        for part in slices(batches, "body"):
            anchor = part.column("anchor").to_numpy()
            change = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
            apart = held and held[-1].column("anchor")[-1].as_py() != anchor[0]
            if size >= BUCKET_BYTES and (apart or len(change)):
                # Equal windows have equal anchors, so a boundary between anchors parts no match.
                cut = 0 if apart else int(change[0])
                yield bucket([*held, part.slice(0, cut)])
                held, size, part = [], 0, part.slice(cut)
            held.append(part)
            size += part.column("body").nbytes
        if held:
            yield bucket(held)

    return run


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, tag, spans``: the byte intervals of each row whose windows also start earlier."""
    found = passages.recurring(passages.occurrences(docs, _bytes, window, gram))
    table = passages.distinct(found)
    # An anchor with one passage has nothing to compare: its windows differ from each other.
    several = stored(table.groupBy("anchor").count().where("count > 1").select("anchor"))
    compared = table.join(several, "anchor", "left_semi")
    full = passages.full_anchors(compared, ANCHOR_PASSAGES)
    read = passages.bodies(passages.once(docs, found), compared, full, _bytes, _bounds, window)
    # Sampled splitters over the leading bytes of the suffixes at the anchors.
    lead = F.substring("body", F.col("offset") + F.lit(1), F.lit(gram))
    whole = read.where("body IS NOT NULL").select(
        "doc_id", "start", "offset", "tag", "anchor", "passage", "body", lead.alias("lead")
    )
    buckets = whole.repartitionByRange("lead", "anchor").sortWithinPartitions("lead", "anchor").drop("lead")
    spans = buckets.mapInArrow(_sorted_buckets(window, gram), "anchor long, passage long, spans array<int>")
    # Windows of full anchors: the earliest place is a partial aggregation.
    place = F.struct(F.col("doc_id").isNull(), "doc_id", F.col("start") + F.col("step"), "tag")
    single = read.where("body IS NULL").withColumn("place", place)
    least = stored(single.groupBy("code").agg(F.min("place").alias("least")))
    step = F.array_sort(F.collect_list("step"))
    split = F.flatten(F.transform(step, lambda s: F.array(s, s + F.lit(window))))
    single = single.join(least, "code").where("place > least").groupBy("anchor", "passage").agg(split.alias("spans"))
    spans = spans.unionByName(single)
    table = stored(table.drop("n").join(spans, ["anchor", "passage"], "left"))
    discard(read)
    joined = found.join(table, ["anchor", "passage"])
    at_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tag") == F.col("first.tag"))
    at_first &= F.col("place") == F.col("first.place")
    whole_span = F.array(F.lit(0), passages.windows_of(F.col("place")) + F.lit(window - 1))
    removed = joined.select("doc_id", "tag", "place", F.when(at_first, F.col("spans")).otherwise(whole_span).alias("spans"))
    return passages.spans_by_row(removed.where("spans IS NOT NULL"))


def remove_repeated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` for every row of ``docs(doc_id, text, ...)``.

    A byte goes if a string of ``window`` bytes that covers it also starts
    earlier: in a row of smaller ``doc_id``, or earlier in the same row.
    Strings are judged on the input.  ``kept`` is binary, as a cut may fall
    inside a character.

    A null text counts as empty.  Texts shorter than ``window`` stay.  Rows with
    a null ``doc_id`` come last.  Rows that repeat both ``doc_id`` and text are
    the same document: what one keeps, all keep.  Other columns are not read.
    """
    joined = passages.with_texts(docs.select("doc_id", "text"), repeated_spans(docs, window, gram)).drop("row", "tag")
    joined = joined.withColumn("wanted", F.coalesce("wanted", F.array().cast("array<bigint>")))

    def run(batches):
        for part in slices(batches, "text"):
            data, offsets = text_bytes(part.column("text"))
            gone = passages.covered(part.column("wanted"), offsets)
            before = np.concatenate([[0], np.cumsum(gone)])
            edge = gone.copy()
            edge[1:] &= ~gone[:-1]
            starts = offsets[:-1][offsets[:-1] < offsets[1:]]
            edge[starts] = gone[starts]
            spans = np.concatenate([[0], np.cumsum(edge)])
            kept = data[~gone].tobytes()
            ends = offsets - before[offsets]
            texts = [kept[s:e] for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            counts = [np.diff(offsets), np.diff(before[offsets]), np.diff(spans[offsets])]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *map(pa.array, counts), pa.array(texts, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    fields = [T.StructField(c, T.LongType()) for c in ("doc_id", "n_bytes", "n_removed", "n_spans")]
    return joined.mapInArrow(run, T.StructType([*fields, T.StructField("kept", T.BinaryType())]))
