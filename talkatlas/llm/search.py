"""Ranked lexical search: hashed max-sketches bound every score, and few documents are scored exactly."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.llm.columns import Powers, mix, slices, text_bytes, word_codes
from talkatlas.runtime import top_n_per_group

TOP = 10
# Coordinates of a sketch.
WIDTH = 2048
# Characters and items that are searched for at once, on average.
BLOCK_CHARS = 1_000_000
BLOCK_ITEMS = 1_000
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}

_IN_TERM = np.array([c > 127 or chr(c).isalnum() for c in range(256)])
_LOWERED = np.array([LOWER.get(c, c) for c in range(256)], np.uint8)


def terms_of(text: str) -> list[str]:
    """The terms of a text: runs of ASCII letters, digits and all other characters beyond ASCII."""
    return TERM.findall(text.translate(LOWER))


class Terms:
    """The terms of a slice of texts: their bytes, their rows, and the terms of each row."""

    def __init__(self, column: pa.Array) -> None:
        data, offsets = text_bytes(column)
        self.data = _LOWERED[data]
        inside = np.concatenate([[False], _IN_TERM[data], [False]])
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        self.starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
        self.ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
        bounds = np.searchsorted(self.starts, offsets)
        self.count = np.diff(bounds)
        self.row = np.repeat(np.arange(len(column)), self.count)

    def known(self, vocabulary: pa.Array, rows: np.ndarray | None = None):
        """Row, number and occurrences of each known term, by row, then number.

        Terms are compared byte by byte.  ``rows`` flags the rows to look at.
        """
        which = np.arange(len(self.row)) if rows is None else np.flatnonzero(rows[self.row])
        lengths = self.ends[which] - self.starts[which]
        at = np.concatenate([[0], np.cumsum(lengths)])
        inside = np.repeat(self.starts[which] - at[:-1], lengths) + np.arange(at[-1])
        buffers = [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(self.data[inside])]
        words = pa.Array.from_buffers(pa.large_binary(), len(which), buffers)
        number = pc.fill_null(pc.index_in(words, value_set=vocabulary), -1).to_numpy(zero_copy_only=False)
        hit = np.flatnonzero(number >= 0)
        width = max(len(vocabulary), 1)
        key, times = np.unique(self.row[which[hit]] * width + number[hit], return_counts=True)
        return key // width, key % width, times

    def sketches(self, powers: Powers, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, coordinate and count: for each the most occurrences of any term folded there.

        Two terms of one 64-bit hash count as one, which can only raise a bound.
        """
        codes = word_codes(self.data, self.starts, self.ends, powers)
        salted = mix(codes + mix(self.row.astype(np.uint64) + np.uint64(1)))
        _, first, times = np.unique(salted, return_index=True, return_counts=True)
        flat = self.row[first] * width + coordinates(codes[first], width)
        order = np.lexsort((-times, flat))
        fresh = np.ones(len(order), bool)
        fresh[1:] = flat[order[1:]] != flat[order[:-1]]
        best = order[fresh]
        return flat[best] // width, flat[best] % width, times[best]


def coordinates(codes: np.ndarray, width: int) -> np.ndarray:
    """Where the terms of these hashes are folded in a sketch."""
    return (codes % np.uint64(width)).astype(np.int64)


def impact(times: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """What a term that occurs so often adds per unit of weight; it grows with ``times``."""
    return 1_000_000_000 * times // (1000 * times + 8 * spread)


def spreads(counts: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The length penalty of documents of so many terms; products are of any size."""
    return np.array([100 - 75 + 75 * n * n_docs // max(n_terms, 1) for n in counts.tolist()], np.int64)


class Items:
    """The items of one block: their terms as numbers of a shared vocabulary, with weights."""

    def __init__(self, items: list[tuple[int, int | None, str]]) -> None:
        self.names = [(number, name) for number, name, _ in items]
        counted = [Counter(terms_of(text)) for _, _, text in items]
        known = sorted({t for c in counted for t in c})
        place = {t: i for i, t in enumerate(known)}
        self.vocabulary = pa.array([t.encode() for t in known], pa.large_binary())
        self.bounds = np.cumsum([0, *map(len, counted)])
        self.term = np.array([place[t] for c in counted for t in c], np.int64)
        self.times = np.array([n for c in counted for n in c.values()], np.int64)
        self.weight = np.zeros(len(self.term), np.int64)

    def weigh(self, holding: dict[int, int], n_docs: int) -> None:
        """Set the weights from the documents that hold each term."""
        of = [holding.get(t, 0) for t in range(len(self.vocabulary))]
        each = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in of], np.int64)
        self.weight = each[self.term] * self.times if len(of) else self.weight

    def folded(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The used coordinates, and the weight that each item has at each of them."""
        column = pa.array(self.vocabulary.to_pylist(), pa.large_string())
        data, offsets = text_bytes(column)
        at = coordinates(word_codes(data, offsets[:-1], offsets[1:], Powers()), width)
        used, place = np.unique(at, return_inverse=True)
        weights = np.zeros((len(self.names), len(used)))
        item = np.repeat(np.arange(len(self.names)), np.diff(self.bounds))
        np.add.at(weights, (item, place[self.term]), self.weight)
        return used, weights


class Searcher:
    """Keeps the best documents of each item while slices of documents pass by."""

    def __init__(self, items: Items, n_docs: int, n_terms: int, k: int, width: int) -> None:
        self.items, self.n_docs, self.n_terms, self.k, self.width = items, n_docs, n_terms, k, width
        self.used, self.weights = items.folded(width)
        self.powers = Powers()
        # Per item the best scores, best first, with their documents; the last is the threshold.
        self.scores = np.zeros((len(items.names), k), np.int64)
        self.docs = [[] for _ in items.names]
        self.scored = 0

    def bounds(self, terms: Terms, spread: np.ndarray) -> np.ndarray:
        """At least the score of every item with every document of the slice."""
        row, at, times = terms.sketches(self.powers, self.width)
        place = np.searchsorted(self.used, at)
        place[place == len(self.used)] = 0
        hit = self.used[place] == at if len(self.used) else np.zeros(len(at), bool)
        sketch = np.zeros((len(self.used), len(spread)))
        sketch[place[hit], row[hit]] = impact(times[hit], spread[row[hit]])
        # Room for the rounding of sums beyond 53 bits.
        return (self.weights @ sketch) * (1 + 1e-9)

    def exact(self, known, item: np.ndarray, row: np.ndarray, spread: np.ndarray) -> np.ndarray:
        """The scores of pairs of an item and a document."""
        rows, number, times = known
        width = max(len(self.items.vocabulary), 1)
        keys = rows * width + number
        sizes = np.diff(self.items.bounds)[item]
        pair = np.repeat(np.arange(len(item)), sizes)
        entry = np.arange(len(pair)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + self.items.bounds[item][pair]
        wanted = row[pair] * width + self.items.term[entry]
        place = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        found = keys[place] == wanted if len(keys) else np.zeros(len(wanted), bool)
        pair, entry, place = pair[found], entry[found], place[found]
        score = np.zeros(len(item), np.int64)
        np.add.at(score, pair, self.items.weight[entry] * impact(times[place], spread[row[pair]]))
        return score

    def see(self, part: pa.RecordBatch) -> None:
        """Score exactly, in the order of falling bounds, while a bound reaches the threshold of its item."""
        terms = Terms(part.column("text"))
        spread = spreads(terms.count, self.n_docs, self.n_terms)
        names = part.column("doc_id").to_pylist()
        bounds = self.bounds(terms, spread)
        order = np.argsort(-bounds, axis=1, kind="stable")
        falling = np.take_along_axis(bounds, order, axis=1)
        hopeful = (falling > 0) & (falling >= self.scores[:, -1:])
        known = terms.known(self.items.vocabulary, np.bincount(order[hopeful], minlength=len(spread)) > 0)
        start, step = 0, self.k
        while hopeful[:, start : start + step].any():
            item, at = np.nonzero(hopeful[:, start : start + step])
            row = order[item, start + at]
            score = self.exact(known, item, row, spread)
            self.scored += len(score)
            for i in np.unique(item[score >= np.maximum(self.scores[item, -1], 1)]).tolist():
                mine = (item == i) & (score > 0)
                self._keep(i, score[mine].tolist(), [names[r] for r in row[mine].tolist()])
            start, step = start + step, 2 * step
            hopeful &= falling >= self.scores[:, -1:]

    def _keep(self, item: int, scores: list[int], docs: list[int | None]) -> None:
        held = [*zip(self.scores[item].tolist(), self.docs[item], strict=False), *zip(scores, docs, strict=True)]
        held.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        held = held[: self.k]
        self.scores[item, : len(held)] = [s for s, _ in held]
        self.docs[item] = [d for _, d in held]

    def found(self) -> pa.RecordBatch:
        rows = [(*name, d, s) for name, docs, scores in zip(self.items.names, self.docs, self.scores, strict=True) for d, s in zip(docs, scores.tolist(), strict=False)]
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["item", "item_id", "doc_id", "score"])


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, int | None, str]]]:
    """The items that have a text, as numbered lists for the driver."""
    usable = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    size, rows = usable.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)), F.count("*")).first()
    count, number = max(-(-size // BLOCK_CHARS), -(-rows // BLOCK_ITEMS)), 0
    for i in range(count):
        block = usable.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == i).orderBy("item_id", "text").collect()
        if block:
            yield [(number + j, r["item_id"], r["text"]) for j, r in enumerate(block)]
            number += len(block)


def _holding(vocabulary: pa.Array):
    """Texts to ``term, n, total``: documents that hold each term, and for -1 all documents and terms."""

    def run(batches):
        held = np.zeros(len(vocabulary), np.int64)
        docs = total = 0
        for part in slices(batches, "text"):
            terms = Terms(part.column("text"))
            held += np.bincount(terms.known(vocabulary)[1], minlength=len(vocabulary))
            docs, total = docs + int((terms.count > 0).sum()), total + int(terms.count.sum())
        some = np.flatnonzero(held)
        columns = [np.append(some, -1), np.append(held[some], docs), np.append(some * 0, total)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["term", "n", "total"])

    return run


def rank(docs: DataFrame, items: DataFrame, k: int = TOP, width: int = WIDTH) -> DataFrame:
    """``item_id, rank, doc_id, score`` for ``docs(doc_id, text, ...)`` and ``items(item_id, text, ...)``.

    Every row of ``items`` gets its ``k`` best rows of ``docs`` with a score
    above zero, all of them if there are fewer.  Equal scores go by ``doc_id``,
    a null one last.

    Items travel to the tasks in blocks of bounded size.  The first pass over
    the documents counts how many hold each term of the block.  In the second, a
    document's impacts fold into a sketch of ``width`` maxima, the weights of all
    items meet all sketches of a slice in one product, and documents are scored
    exactly in the order of these bounds until none reaches an item's threshold.
    A task sends out ``k`` rows per item.

    Null and empty texts have no terms: as documents they do not count, as items
    they find nothing.  Repeated documents count and rank each, repeated items
    give repeated results, and null ids stay null.  Other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for block in _blocks(items):
        asked = Items(block)
        shared = spark.sparkContext.broadcast(asked.vocabulary.to_pylist())

        def counted(batches, shared=shared):
            return _holding(pa.array(shared.value, pa.large_binary()))(batches)

        counts = texts.select("text").mapInArrow(counted, "term long, n long, total long")
        # One row per term of the block.
        sums = counts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
        holding = {r["term"]: r["n"] for r in sums}
        n_docs, n_terms = holding.pop(-1, 0), sum(r["total"] for r in sums)
        asked.weigh(holding, n_docs)
        weighed = spark.sparkContext.broadcast((block, asked.weight, n_docs, n_terms))

        def run(batches, weighed=weighed):
            listed, weight, n_docs, n_terms = weighed.value
            own = Items(listed)
            own.weight = weight
            searcher = Searcher(own, n_docs, n_terms, k, width)
            for part in slices(batches, "text"):
                searcher.see(part)
            yield searcher.found()

        part = texts.mapInArrow(run, "item long, item_id long, doc_id long, score long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        schema = T.StructType.fromDDL("item_id long, rank int, doc_id long, score long")
        return spark.createDataFrame([], schema)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    return top_n_per_group(found, "item", order, k).select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH split AS (
  SELECT doc_id, row_number() OVER () AS place,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), totals AS (
  SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM split WHERE len(terms) > 0
), held AS (
  SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(terms) AS term FROM split) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), totals
), asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (
    SELECT item_id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
  ) GROUP BY ALL
), lengths AS (
  SELECT place, doc_id, 100 - 75 + ((75 * len(terms) * n_docs) // n_terms) AS m FROM split, totals WHERE len(terms) > 0
), scored AS (
  SELECT item_id, place, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN lengths USING (place)
  GROUP BY item_id, place, doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
