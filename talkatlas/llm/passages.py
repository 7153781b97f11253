"""Texts cut at content-defined anchors, so that equal windows meet without shipping all windows.

A window is ``window`` consecutive symbols (words or bytes) of one row.  Its
anchor is the smallest hash among its ``gram``-symbol substrings, the leftmost
of equal ones.  Equal windows have equal anchors at equal offsets.  Consecutive
windows of one anchor overlap, and together cover one passage of at most
``2 * window - gram`` symbols; every window lies in exactly one passage.  So a
table of passages, keyed by anchor, stands for the table of all windows at a
small part of its size, and a window can only recur in passages of its anchor.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkatlas.llm.columns import Powers, mix, prefix_sums, slices
from talkatlas.runtime import discard, stored

# Symbols of a text column: a 64-bit code per symbol, and the offsets of the rows.
Symbols = Callable[[pa.Array, Powers], tuple[np.ndarray, np.ndarray]]
TAG = "struct<x:bigint,y:bigint>"


def split(codes: np.ndarray, offsets: np.ndarray, window: int, gram: int, powers: Powers):
    """Row, first symbol, offset of the anchor, number of windows, anchor and content hash of each passage."""
    n = len(codes)
    if n < window:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums = prefix_sums(codes, powers)
    down = powers(n + 1)[1]
    grams = mix((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
    # The high bits of the hash with the position below: a minimum is the leftmost one.
    low = np.uint64((1 << max(24, n.bit_length())) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width, reach = window - gram + 1, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: n - window + 1], least[width - reach : width - reach + n - window + 1])
    anchors = (least & low).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    whole = np.flatnonzero(row[: n - window + 1] == row[window - 1 :])
    if not len(whole):
        return split(codes[:0], offsets[:1], window, gram, powers)
    anchors = anchors[whole]
    cut = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(whole)]]) - 1
    start, end = whole[first], whole[last] + window
    passage = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    rows = row[start]
    at = anchors[first]
    return rows, start - offsets[rows], at - start, last - first + 1, grams[at], passage


def tag_of(text: Column) -> Column:
    """128 bits of a text, which tell apart the rows that share a ``doc_id``."""
    return F.struct(F.xxhash64(text).alias("x"), F.xxhash64(F.lit(1), text).alias("y"))


def with_tag(docs: DataFrame) -> DataFrame:
    """``doc_id, tag, text``; ``doc_id`` and tag name a row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), tag_of(text).alias("tag"), text.alias("text"))


def start_of(place: Column) -> Column:
    return F.shiftright(place, 32)


def offset_of(place: Column) -> Column:
    return F.shiftright(place, 8).bitwiseAND(F.lit(0xFF)).cast("int")


def windows_of(place: Column) -> Column:
    return place.bitwiseAND(F.lit(0xFF)).cast("int")


def occurrences(docs: DataFrame, symbols: Symbols, window: int, gram: int) -> DataFrame:
    """``doc_id, tag, place, anchor, passage`` for every passage of every row.

    ``place`` packs the first symbol, the offset of the anchor and the number of
    windows.
    """
    if not 0 < gram <= window or window - gram + 1 > 255:
        raise ValueError("a passage can have at most 255 windows")

    def run(batches):
        powers = Powers()
        for part in slices(batches, "text"):
            codes, offsets = symbols(part.column("text"), powers)
            row, start, offset, count, anchor, passage = split(codes, offsets, window, gram, powers)
            place = (start << 32) | (offset << 8) | count
            arrays = [place, anchor.view(np.int64), passage.view(np.int64)]
            ids = [part.column(c).take(pa.array(row)) for c in ("doc_id", "tag")]
            names = ["doc_id", "tag", "place", "anchor", "passage"]
            yield pa.RecordBatch.from_arrays([*ids, *map(pa.array, arrays)], names)

    return with_tag(docs).mapInArrow(run, f"doc_id long, tag {TAG}, place long, anchor long, passage long")


def recurring(found: DataFrame) -> DataFrame:
    """The passages whose anchor occurs more than once; no other window can recur.

    Rows that repeat both ``doc_id`` and text give one entry per passage, with
    their number ``m``.
    """
    found = stored(found.withColumn("m", F.lit(1).cast("long")))
    # Every row with a window has one passage that starts at its first symbol.
    rows = found.where(F.col("place") < (1 << 32)).groupBy("doc_id", "tag").count()
    if not rows.where("count > 1").isEmpty():
        # Added up before the join below, where all passages of an anchor meet.
        every, found = found, stored(found.groupBy("doc_id", "tag", "place", "anchor", "passage").agg(F.sum("m").alias("m")))
        discard(every)
    anchors = stored(found.groupBy("anchor").agg(F.sum("m").alias("n")).where("n > 1").select("anchor"))
    kept = stored(found.join(anchors, "anchor", "left_semi"))
    # The table of all passages is the largest of all.
    discard(found)
    discard(anchors)
    return kept


def distinct(found: DataFrame) -> DataFrame:
    """Each passage once per anchor, with its count ``n`` and its ``first`` place."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "place", "tag")).alias("first")
    return stored(found.groupBy("anchor", "passage").agg(F.sum("m").alias("n"), first))


def once(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``doc_id, text`` of ``docs``, rows that repeat both once, if ``found`` tells that some do."""
    texts = docs.select("doc_id", "text")
    return texts if found.where("m > 1").isEmpty() else texts.distinct()


def with_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc_id, tag, text, row, wanted``: each row of ``docs`` with its entries of ``wanted``.

    ``wanted`` has ``doc_id, tag`` and one more column, for each pair at most
    once.  ``row`` holds all columns of ``docs`` but the text.
    """
    rest = [c for c in docs.columns if c != "text"]
    kept = F.struct(*rest).alias("row") if rest else F.struct(F.lit(0)).alias("row")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    left = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        tag_of(text).alias("tag"),
        text.alias("text"),
        kept,
    ).alias("d")
    right = wanted.alias("w")
    same = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.tag") == F.col("w.tag"))
    name = next(c for c in wanted.columns if c not in ("doc_id", "tag"))
    return left.join(right, same, "left").select("d.doc_id", "d.tag", "d.text", "d.row", F.col(f"w.{name}").alias("wanted"))


def bodies(docs: DataFrame, table: DataFrame, full: DataFrame, symbols, bounds, window: int) -> DataFrame:
    """The text of each distinct passage, read at its first place; ``docs`` repeats no row.

    ``doc_id, tag, start, offset, anchor, passage, n, step, code, body``.  An anchor
    in ``full`` has too many different passages for one task.  Its passages come as single
    windows instead, with ``step`` and the window's hash ``code``, no body.
    """
    marked = table.join(full.withColumn("full", F.lit(True)), "anchor", "left")
    place = F.col("first.place")
    entry = F.struct(
        start_of(place).alias("start"),
        offset_of(place).alias("offset"),
        windows_of(place).alias("windows"),
        "anchor", "passage", "n", F.coalesce("full", F.lit(False)).alias("full"),
    )
    by_doc = marked.groupBy(F.col("first.doc_id").alias("doc_id"), F.col("first.tag").alias("tag"))
    wanted = by_doc.agg(F.collect_list(entry).alias("wanted"))

    def run(batches):
        powers = Powers()
        for part in slices(batches, "text"):
            column = part.column("text")
            codes, offsets = symbols(column, powers)
            sums = prefix_sums(codes, powers)
            down = powers(len(codes) + 1)[1]
            data, begins, ends = bounds(column)
            lists = part.column("wanted")
            item = lists.flatten()
            field = {f.name: item.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(item.type)}
            row = np.repeat(np.arange(len(part)), np.diff(lists.offsets.to_numpy()))
            at = offsets[row] + field["start"]
            stop = at + field["windows"] + window - 1
            whole = np.flatnonzero(~field["full"])
            raw = data.tobytes()
            cuts = zip(begins[at[whole]].tolist(), ends[stop[whole] - 1].tolist(), strict=True)
            body = [raw[s:e] for s, e in cuts]
            many = np.flatnonzero(field["full"])
            steps = field["windows"][many]
            again = np.repeat(many, steps)
            step = np.arange(len(again)) - np.repeat(np.cumsum(steps) - steps, steps)
            s = at[again] + step
            code = mix((sums[s + window] - sums[s]) * down[s])
            order = np.concatenate([whole, again]).astype(np.int64)
            none = np.zeros(len(whole), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c).take(pa.array(row[order])) for c in ("doc_id", "tag")),
                    pa.array(field["start"][order]),
                    *(pa.array(field[c][order]) for c in ("offset", "anchor", "passage", "n")),
                    pa.array(np.concatenate([none, step]).astype(np.int32)),
                    pa.array(np.concatenate([none, code.view(np.int64)])),
                    pa.array(body + [None] * len(again), pa.binary()),
                ],
                ["doc_id", "tag", "start", "offset", "anchor", "passage", "n", "step", "code", "body"],
            )

    schema = f"doc_id long, tag {TAG}, start long, offset int, anchor long, passage long, n long, step int, code long, body binary"
    rows = with_texts(docs.select("doc_id", "text"), wanted).where("wanted IS NOT NULL").drop("row")
    return stored(rows.mapInArrow(run, schema))


def full_anchors(table: DataFrame, most: int) -> DataFrame:
    return stored(table.groupBy("anchor").count().where(F.col("count") > most).select("anchor"))


def spans_by_row(removed: DataFrame) -> DataFrame:
    """``doc_id, tag, spans``: all removed intervals of a row, flat, from ``doc_id, tag, place, spans``."""
    start = start_of(F.col("place"))
    moved = F.transform("spans", lambda s: start + s)
    return removed.groupBy("doc_id", "tag").agg(
        F.flatten(F.collect_list(moved)).alias("spans")
    )


def covered(lists: pa.Array, offsets: np.ndarray) -> np.ndarray:
    """For each symbol of a slice, whether an interval of its row covers it."""
    n = int(offsets[-1])
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = flat + np.repeat(offsets[:-1], lengths)
    change = np.bincount(flat[0::2], minlength=n + 1) - np.bincount(flat[1::2], minlength=n + 1)
    return np.cumsum(change[:n]) > 0


def runs(flags: np.ndarray, reach: int) -> list[int]:
    """The flagged positions, each covering ``reach`` symbols, as flat merged intervals."""
    at = np.flatnonzero(flags)
    cut = np.flatnonzero(np.diff(at) > reach)
    begin, end = np.concatenate([at[:1], at[cut + 1]]), np.concatenate([at[cut], at[-1:]]) + reach
    return np.stack([begin, end], axis=1).ravel().tolist()
