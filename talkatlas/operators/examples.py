"""Per cluster: a seeded sample of its rows and its nearest outside rows.

Both are computed for all clusters in one plan.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.checks import require_columns
from talkatlas.functions import vectors
from talkatlas.operators.cluster import centroid_blocks, centroids, labelled
from talkatlas.params import NamingParams
from talkatlas.runtime import is_small, stored, top_n_per_group, with_last

# Blocks of centroids that one scan takes along, and rows that are compared with a block at once.
BLOCKS_PER_SCAN = 16
SLICE_ROWS = 1024
# Picked rows hold an id and three small fields: this many are safe to broadcast.
MAX_PICKS = 200_000


def sample_in_cluster(
    df: DataFrame, n: int = 50, seed: int = 42, cluster_col: str = "cluster_id", id_col: str = "id"
) -> DataFrame:
    """``(cluster_id, id, rank)``: up to ``n`` rows per cluster, in random order.

    The order is a hash of seed, cluster and id: it does not depend on how the
    table is partitioned, and each cluster is shuffled with its own seed.
    """
    require_columns(df, cluster_col, id_col)
    rows = labelled(df, cluster_col)
    draw = F.md5(F.concat_ws(":", F.lit(seed) + F.col("cluster_id"), "cluster_id", F.col(id_col)))
    rows = rows.select("cluster_id", F.col(id_col).alias("id"), draw.alias("draw"))
    return top_n_per_group(rows, "cluster_id", [F.col("draw"), F.col("id")], n).drop("draw")


def nearest_outside(
    df: DataFrame,
    points: DataFrame,
    n: int = 50,
    cluster_col: str = "cluster_id",
    id_col: str = "id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``(cluster_id, id, distance, rank)``: rows of other clusters nearest to each centroid."""
    return _extreme_rows(df, points, n, cluster_col, id_col, vector_col, outside=True)


def farthest_inside(
    df: DataFrame,
    points: DataFrame,
    n: int = 5,
    cluster_col: str = "cluster_id",
    id_col: str = "id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``(cluster_id, id, distance, rank)``: the outliers of each cluster."""
    return _extreme_rows(df, points, n, cluster_col, id_col, vector_col, outside=False)


def _extreme_rows(df, points, n, cluster_col, id_col, vector_col, outside: bool) -> DataFrame:
    """Top rows per centroid by distance, cut in the tasks before the shuffle.

    A task keeps ``n`` rows per centroid while it reads its batches, so the
    pairs of rows and centroids exist only as a matrix product inside a slice.
    All blocks of centroids pass in one scan, unless there are very many.
    """
    require_columns(df, cluster_col, id_col, vector_col)
    require_columns(points, "cluster_id", "centroid")
    rows = labelled(df, cluster_col).where(F.col(vector_col).isNotNull())
    rows = rows.select("cluster_id", F.col(id_col).alias("id"), F.col(vector_col).alias("embedding"))
    schema = T.StructType(
        [
            rows.schema["cluster_id"],
            rows.schema["id"],
            T.StructField("distance", T.DoubleType()),
        ]
    )
    spark, found, held = df.sparkSession, None, []
    for block, last in with_last(centroid_blocks(points)):
        held.append(spark.sparkContext.broadcast(block))
        if last or len(held) == BLOCKS_PER_SCAN:
            part = rows.mapInArrow(_keep_extremes(held, n, outside), schema)
            found, held = part if found is None else found.unionAll(part), []
    if found is None:
        found = spark.createDataFrame([], schema)
    distance = F.asc("distance") if outside else F.desc("distance")
    return top_n_per_group(found, "cluster_id", [distance, F.asc("id")], n)


class _Extremes:
    """The best rows so far of each centroid of one block."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, n: int, outside: bool) -> None:
        self.ids, self.points, self.n, self.outside = ids, points, n, outside
        self.sign = 1.0 if outside else -1.0
        # The squared distance of the worst kept row, once there are enough.
        self.bound = np.full(len(ids), np.inf)
        self.kept: list[pa.Table] = []
        self.waiting = 0

    def add(self, own: np.ndarray, names: pa.Array, rows: np.ndarray) -> None:
        sq, slack = vectors.squared_screen(rows, self.points)
        allowed = (own[:, None] != self.ids) if self.outside else (own[:, None] == self.ids)
        score = np.where(allowed, self.sign * sq, np.inf)
        limit = self.bound
        if len(rows) > self.n:
            # Only the best rows of a slice can stay.
            limit = np.minimum(limit, np.partition(score, self.n - 1, axis=0)[self.n - 1])
        row, place = np.nonzero(allowed & (score <= limit + 2 * slack.max()))
        for start in range(0, len(row), vectors.PAIR_SLICE):
            r, c = row[start : start + vectors.PAIR_SLICE], place[start : start + vectors.PAIR_SLICE]
            gap = vectors.exact_distance(rows[r], self.points[c])
            self.kept.append(pa.table({"place": c, "id": names.take(pa.array(r)), "distance": gap}))
        self.waiting += len(row)
        if self.waiting > self.n * len(self.ids) // 2:
            self._cut()

    def _cut(self) -> None:
        """Keep the first rows of each centroid, and tighten its bound."""
        if not self.kept:
            return
        order = [("place", "ascending"), ("distance", "ascending" if self.outside else "descending"), ("id", "ascending")]
        table = pa.concat_tables(self.kept).sort_by(order)
        place = table["place"].to_numpy()
        rank = np.arange(len(place)) - np.searchsorted(place, place)
        table = table.filter(pa.array(rank < self.n))
        full = np.flatnonzero(rank == self.n - 1)
        gap = table["distance"].to_numpy()[np.cumsum(rank < self.n)[full] - 1]
        self.bound[place[full]] = self.sign * gap**2
        self.kept, self.waiting = [table], 0

    def found(self) -> list[pa.RecordBatch]:
        self._cut()
        if not self.kept:
            return []
        table = self.kept[0]
        labels = pa.array(self.ids[table["place"].to_numpy()], pa.int32())
        return table.select(["id", "distance"]).add_column(0, "cluster_id", labels).combine_chunks().to_batches()


def _keep_extremes(shared: list, n: int, outside: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [_Extremes(*block.value, n, outside) for block in shared]
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                own = part.column(0).to_numpy(zero_copy_only=False)
                rows = vectors.matrix(part.column(2))
                for block in blocks:
                    block.add(own, part.column(1), rows)
        for block in blocks:
            yield from block.found()

    return run


def example_rows(
    df: DataFrame,
    params: NamingParams | None = None,
    id_col: str = "id",
    vector_col: str = "embedding",
    cluster_ids: Sequence[int] | None = None,
    points: DataFrame | None = None,
) -> DataFrame:
    """``(cluster_id, kind, rank, id)`` with kind ``in`` or ``out``, for all clusters.

    ``points`` are the centroids, if already at hand.  With ``cluster_ids`` only
    those clusters are done.
    """
    p = params or NamingParams()
    members = df
    if points is None:
        points = centroids(df, p.cluster_col, vector_col)
    if cluster_ids is not None:
        wanted = list(cluster_ids)
        members = labelled(df, p.cluster_col).where(F.col("cluster_id").isin(wanted))
        points = points.where(F.col("cluster_id").isin(wanted))
    member_col = p.cluster_col if cluster_ids is None else "cluster_id"
    inside = sample_in_cluster(members, p.in_cluster_n, p.random_state, member_col, id_col)
    outside = nearest_outside(df, points, p.out_cluster_n, p.cluster_col, id_col, vector_col)
    return inside.select("cluster_id", F.lit("in").alias("kind"), "rank", "id").unionByName(
        outside.select("cluster_id", F.lit("out").alias("kind"), "rank", "id")
    )


def with_texts(picks: DataFrame, df: DataFrame, text_col: str, id_col: str = "id") -> DataFrame:
    """Add ``text`` to picked rows; ``picks`` should be a stored table.

    The picks are few (clusters times examples).  Within ``MAX_PICKS`` they go
    to the tasks, and the table with the texts is read once without a shuffle.
    """
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    small = is_small(picks, MAX_PICKS)
    return texts.join(F.broadcast(picks) if small else picks, "id")


def example_bundles(
    df: DataFrame,
    params: NamingParams | None = None,
    id_col: str = "id",
    vector_col: str = "embedding",
    cluster_ids: Sequence[int] | None = None,
) -> DataFrame:
    """One row per cluster: ``in_ids, in_texts, out_ids, out_texts`` and the sizes.

    Each array holds at most the number of examples set in ``params``.  A
    cluster id that was asked for but has no rows gives empty arrays.
    """
    p = params or NamingParams()
    require_columns(df, p.text_col, p.cluster_col, id_col, vector_col)
    picks = stored(example_rows(df, p, id_col, vector_col, cluster_ids))
    rows = with_texts(picks, df, p.text_col, id_col)

    def collected(kind: str, field: str):
        found = F.collect_list(
            F.when(F.col("kind") == kind, F.struct("rank", "id", F.coalesce("text", F.lit("")).alias("text")))
        )
        return F.transform(F.array_sort(found), lambda s: s[field])

    bundles = rows.groupBy("cluster_id").agg(
        collected("in", "id").alias("in_ids"),
        collected("in", "text").alias("in_texts"),
        collected("out", "id").alias("out_ids"),
        collected("out", "text").alias("out_texts"),
        F.count_if(F.col("kind") == "in").alias("in_sample_size"),
        F.count_if(F.col("kind") == "out").alias("out_sample_size"),
    )
    if cluster_ids is None:
        return bundles
    asked = df.sparkSession.createDataFrame([(int(c),) for c in cluster_ids], "cluster_id INT")
    filled = asked.join(bundles, "cluster_id", "left")
    arrays = ("in_ids", "in_texts", "out_ids", "out_texts")
    empty = {c: F.coalesce(c, F.array().cast(bundles.schema[c].dataType)) for c in arrays}
    sizes = {c: F.coalesce(c, F.lit(0)) for c in ("in_sample_size", "out_sample_size")}
    return filled.withColumns({**empty, **sizes})
