"""Exact top-k inner products of integer vectors by MaxScore over signed postings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkatlas.runtime import salt_count, stored, top_n_per_group

SCALE = 256
TOP = 5
# Components of one shard of candidates.
SHARD_VALUES = 1 << 22
# Rows that give a query its first threshold, and the best partial sums that raise it.
START_ROWS = 256
RAISE_ROWS = 64
# Rows up to which what is left is scored at once, and terms between two cuts of the candidates.
FEW_ROWS = 64
CUT_TERMS = 8


def quantized(x: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of every component; null where one is null or not finite."""
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    whole = F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")).cast("long"))
    return F.when(x.isNotNull() & finite, whole)


class Shard:
    """Integer vectors with one posting list per component and sign.

    A component is a term.  What a term adds to a score is at most its weight
    in the query times the largest component of the same sign in the shard.
    """

    def __init__(self, ids: np.ndarray, keys: np.ndarray, rows: np.ndarray) -> None:
        self.ids, self.keys, self.rows = ids, keys, rows
        self.columns = np.ascontiguousarray(rows.T)
        self.rising = [np.flatnonzero(c > 0) for c in self.columns]
        self.falling = [np.flatnonzero(c < 0) for c in self.columns]
        self.most = self.columns.max(axis=1, initial=0)
        self.least = self.columns.min(axis=1, initial=0)

    def _own(self, name: int, key: int) -> int:
        """The place of the query's own row, or -1."""
        at = np.searchsorted(self.ids, name)
        while at < len(self.ids) and self.ids[at] == name:
            if self.keys[at] == key:
                return int(at)
            at += 1
        return -1

    def _scores(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        return self.rows[at] @ query

    def search(self, name: int, key: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the ``k`` best rows but the query's own; ties in the order of rows."""
        weight = np.zeros(self.rows.shape[1], np.int64)
        shared = min(len(query), len(weight))
        weight[:shared] = query[:shared]
        own = self._own(name, key)
        at = self._competitive(weight, own, k)
        score = self._scores(at, weight)
        order = np.lexsort((at, -score))[:k]
        return at[order], score[order]

    def _kth(self, at: np.ndarray, weight: np.ndarray, k: int) -> int:
        score = self._scores(at, weight)
        return int(np.partition(score, len(score) - k)[len(score) - k])

    def _competitive(self, weight: np.ndarray, own: int, k: int) -> np.ndarray:
        """Rows, ascending, among which the ``k`` best are, all ties included."""
        every = np.delete(np.arange(len(self.rows)), own) if own >= 0 else np.arange(len(self.rows))
        if len(every) <= max(k, FEW_ROWS):
            return every
        threshold = self._kth(every[:START_ROWS], weight, k)
        # A row that has none of the essential terms scores at most zero plus the rest.
        if threshold <= 0:
            return every
        bound = np.where(weight > 0, weight * self.most, weight * self.least)
        order = np.argsort(bound, kind="stable")
        sums = np.cumsum(bound[order])
        # All terms before the split together stay below the threshold.
        split = int(np.searchsorted(sums, threshold, side="left"))
        rest = int(sums[split - 1]) if split else 0
        partial = np.zeros(len(self.rows), np.int64)
        for term in order[split:]:
            posting = (self.rising if weight[term] > 0 else self.falling)[term]
            partial[posting] += weight[term] * self.columns[term][posting]
        if own >= 0:
            partial[own] = -1 - rest
        at = np.flatnonzero(partial + rest >= threshold)
        if len(at) > RAISE_ROWS:
            # Not all bounds are that high, so the best partial sums soon raise the threshold.
            best = at[np.argpartition(-partial[at], RAISE_ROWS - 1)[:RAISE_ROWS]]
            threshold = max(threshold, self._kth(best, weight, k))
        held = partial[at]
        # The components of essential terms that lower a score, then all of the other terms.
        probes = [(t, True) for t in order[split:][::-1]] + [(t, False) for t in order[:split][::-1]]
        for done, (term, essential) in enumerate(probes):
            if done % CUT_TERMS == 0:
                still = held + rest >= threshold
                at, held = at[still], held[still]
                if len(at) <= FEW_ROWS:
                    break
            part = weight[term] * self.columns[term][at]
            if essential:
                held += np.minimum(part, 0)
            else:
                held += part
                rest -= int(bound[term])
        return at


def _shard(parts: list[pa.RecordBatch]) -> Shard:
    table = pa.Table.from_batches(parts)
    vectors = table.column("v").combine_chunks()
    sizes = vectors.value_lengths().to_numpy()
    rows = np.zeros((len(table), int(sizes.max(initial=0))), np.int64)
    rows[np.arange(rows.shape[1])[None, :] < sizes[:, None]] = vectors.flatten().to_numpy()
    return Shard(table.column("id").to_numpy(), table.column("key").to_numpy(), rows)


def _answers(k: int):
    """Sorted shards, each followed by its queries, to the best rows of each query in the shard."""

    def run(batches):
        number, held, shard = None, [], None
        for batch in batches:
            while len(batch):
                numbers, asks = batch.column("shard").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
                if numbers[0] != number:
                    number, held, shard = numbers[0], [], None
                change = np.flatnonzero((numbers != numbers[0]) | (asks != asks[0]))
                part = batch.slice(0, int(change[0]) if len(change) else len(batch))
                batch = batch.slice(len(part))
                if not asks[0]:
                    held.append(part)
                    continue
                if shard is None and held:
                    shard, held = _shard(held), []
                if shard is not None:
                    yield _asked(shard, part, k)

    return run


def _asked(shard: Shard, part: pa.RecordBatch, k: int) -> pa.RecordBatch:
    vectors = part.column("v")
    flat, ends = vectors.flatten().to_numpy(), np.cumsum(vectors.value_lengths().to_numpy())
    names, keys = part.column("id").to_numpy(), part.column("key").to_numpy()
    found = [
        shard.search(name, key, query, k)
        for name, key, query in zip(names, keys, np.split(flat, ends[:-1]), strict=True)
    ]
    sizes = [len(at) for at, _ in found]
    at, score = np.concatenate([a for a, _ in found]), np.concatenate([s for _, s in found])
    columns = [np.repeat(names, sizes), np.repeat(keys, sizes), shard.ids[at], shard.keys[at], score]
    return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["query_id", "query_key", "vec_id", "vec_key", "score"])


def top_products(rows: DataFrame, asks: Column, k: int = TOP, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score`` for ``rows(vec_id, embedding, ...)``.

    Vectors become ``floor(scale * x)`` per component.  Each row for which
    ``asks`` holds gets its ``k`` best other rows by inner product, all of them
    if there are fewer; ties go to the smaller ``vec_id``.

    Candidates are dealt to shards of bounded size.  The queries follow the rows
    of every shard and stream past its postings, so neither side is ever whole
    in one place, and a shard answers with ``k`` rows a query.

    A null ``vec_id``, a null vector and one with null or non-finite components
    take no part.  Rows equal in id and vector count once; rows of one id with
    different vectors are separate queries and candidates.  Vectors of different
    length share their first components, so an empty one scores zero.  Scores
    have to fit into 64 bits.  Other columns are not read.
    """
    usable = rows.select(F.col("vec_id").cast("long").alias("id"), quantized(F.col("embedding"), scale).alias("v"), asks.alias("asks"))
    usable = usable.where("id IS NOT NULL AND v IS NOT NULL")
    known = usable.groupBy("id", "v").agg(F.coalesce(F.bool_or("asks"), F.lit(False)).alias("asks"))
    known = stored(known.withColumn("key", F.xxhash64("v")))
    values = known.agg(F.coalesce(F.sum(F.size("v")), F.lit(0))).first()[0]
    shards = max(salt_count(rows.sparkSession), -(-values // SHARD_VALUES))
    dealt = F.pmod(F.xxhash64("id", "key"), F.lit(shards)).cast("int")
    candidates = known.select(dealt.alias("shard"), F.lit(False).alias("asks"), "id", "key", "v")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    queries = known.where("asks").select(everywhere.alias("shard"), F.lit(True).alias("asks"), "id", "key", "v")
    order = ["shard", "asks", "id", "key"]
    lined = candidates.unionByName(queries).repartition("shard").sortWithinPartitions(*order)
    schema = "query_id long, query_key long, vec_id long, vec_key long, score long"
    found = lined.mapInArrow(_answers(k), schema).withColumn("query", F.struct("query_id", "query_key"))
    best = top_n_per_group(found, "query", [F.desc("score"), F.asc("vec_id"), F.asc("vec_key")], k)
    return best.select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM whole q, whole c
  WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
