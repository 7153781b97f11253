"""Removal of word windows that recur anywhere, by FM-indexes over shards of passages."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.llm import passages
from talkatlas.llm.columns import Powers, slices, text_bytes, word_bounds, word_codes
from talkatlas.llm.fm_index import FMIndex
from talkatlas.runtime import discard, stored

WINDOW = 35
GRAM = 8
# Words of one index.  An anchor stays in one index, so this is a lower bound where one is larger.
SHARD_WORDS = 1 << 18
# An anchor with more different passages than this is counted window by window.
ANCHOR_PASSAGES = 2_000


def _words(column: pa.Array, powers: Powers):
    data, offsets = text_bytes(column)
    starts, ends, rows = word_bounds(data, offsets)
    return word_codes(data, starts, ends, powers), rows


def _bounds(column: pa.Array):
    data, offsets = text_bytes(column)
    return data, *word_bounds(data, offsets)[:2]


def _indexed(window: int):
    """Sorted passages with bodies to ``anchor, passage, spans``, one FM-index per shard."""

    def shard(parts: list[pa.RecordBatch], powers: Powers) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        column = table.column("body").combine_chunks().cast(pa.string())
        codes, rows = _words(column, powers)
        known, symbols = np.unique(codes, return_inverse=True)
        lengths = np.diff(rows)
        index = FMIndex(symbols + 1, lengths, table.column("n").to_numpy(), window)
        flags = index.recurring(symbols + 1, lengths)
        spans = [passages.runs(flags[s:e], window) for s, e in zip(rows[:-1], rows[1:], strict=True)]
        hit = [i for i, s in enumerate(spans) if s]
        found = table.select(["anchor", "passage"]).take(hit).combine_chunks().to_batches()
        columns = found[0].columns if found else [pa.array([], pa.int64())] * 2
        lists = pa.array([spans[i] for i in hit], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([*columns, lists], ["anchor", "passage", "spans"])

    def run(batches):
        powers, held, size = Powers(), [], 0
        for part in slices(batches, "body"):
            anchor = part.column("anchor").to_numpy()
            change = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
            if size >= SHARD_WORDS and (held[-1].column("anchor")[-1].as_py() != anchor[0] or len(change)):
                cut = 0 if held[-1].column("anchor")[-1].as_py() != anchor[0] else int(change[0])
                yield shard([*held, part.slice(0, cut)], powers)
                held, size, part = [], 0, part.slice(cut)
            held.append(part)
            # A word takes about six bytes.
            size += part.column("body").nbytes // 6
        if held:
            yield shard(held, powers)

    return run


def recurring_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, tag, spans``: the word intervals of each row that recurring windows cover."""
    found = passages.recurring(passages.occurrences(docs, _words, window, gram))
    table = passages.distinct(found)
    full = passages.full_anchors(table, ANCHOR_PASSAGES)
    read = passages.bodies(passages.once(docs, found), table, full, _words, _bounds, window)
    whole = read.where("body IS NOT NULL").select("anchor", "passage", "n", "body")
    shards = whole.repartition("anchor").sortWithinPartitions("anchor")
    schema = "anchor long, passage long, spans array<int>"
    spans = shards.mapInArrow(_indexed(window), schema)
    # Windows of full anchors: summed before they meet, so that no task sees them all.
    single = read.where("body IS NULL").select("anchor", "passage", "n", "step", "code")
    totals = stored(single.groupBy("code").agg(F.sum("n").alias("total")).where("total > 1").select("code"))
    step = F.array_sort(F.collect_list("step"))
    split = F.flatten(F.transform(step, lambda s: F.array(s, s + F.lit(window))))
    single = single.join(totals, "code", "left_semi").groupBy("anchor", "passage").agg(split.alias("spans"))
    spans = stored(spans.unionByName(single))
    discard(read)
    return passages.spans_by_row(found.join(spans, ["anchor", "passage"]).select("doc_id", "tag", "place", "spans"))


def _cleaned(docs: DataFrame, window: int, gram: int, rejoin: bool) -> DataFrame:
    """``row, doc_id, text, n_words, n_removed``, the text without recurring windows.

    Without ``rejoin`` texts that lose no word keep their white space.
    """
    joined = passages.with_texts(docs, recurring_spans(docs, window, gram))
    joined = joined.withColumn("wanted", F.coalesce("wanted", F.array().cast("array<bigint>")))

    def run(batches):
        for part in slices(batches, "text"):
            data, offsets = text_bytes(part.column("text"))
            _, _, rows = word_bounds(data, offsets)
            gone = passages.covered(part.column("wanted"), rows)
            raw, kept = data.tobytes(), []
            for i in range(len(part)):
                text, mask = raw[offsets[i] : offsets[i + 1]], gone[rows[i] : rows[i + 1]]
                if mask.any():
                    text = b" ".join(itertools.compress(text.split(), (~mask).tolist()))
                elif rejoin:
                    text = b" ".join(text.split())
                kept.append(text)
            total = np.diff(rows)
            removed = np.add.reduceat(np.append(gone, False).astype(np.int64), rows[:-1]) if len(gone) else total * 0
            removed = np.where(total > 0, removed, 0)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc_id"), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(total), pa.array(removed)],
                ["row", "doc_id", "text", "n_words", "n_removed"],
            )

    counts = [T.StructField(c, T.LongType()) for c in ("n_words", "n_removed")]
    schema = T.StructType([joined.schema["row"], joined.schema["doc_id"], joined.schema["text"], *counts])
    return joined.drop("tag").mapInArrow(run, schema)


def remove_recurring(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row of ``docs(doc_id, text, ...)``.

    Words are runs of bytes other than ASCII white space.  Every word in a
    window of ``window`` words that also starts anywhere else goes, the first
    occurrence too; windows are judged on the input.  ``kept`` joins the rest
    by single spaces.

    A null text counts as empty: no words.  Texts shorter than a window are
    kept.  A repeated row is another document, so the windows of both recur.
    Rows with equal or null ``doc_id`` are told apart by 128 bits of their texts.  Other columns are not read.
    """
    kept = _cleaned(docs.select("doc_id", "text"), window, gram, rejoin=True)
    return kept.select("doc_id", "n_words", "n_removed", F.col("text").alias("kept"))


def replace_texts(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` with its texts as ``remove_recurring`` leaves them; untouched texts stay as they are."""
    kept = _cleaned(docs, window, gram, rejoin=False)
    return kept.select(*(F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))
