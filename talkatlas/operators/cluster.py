"""K-means over embeddings, cluster sizes, centroids and row assignment."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.checks import require_columns
from talkatlas.functions import vectors
from talkatlas.runtime import is_small, join_small, row_blocks, stored, with_last


def choose_k(n_rows: int, k_min: int = 3, k_max: int = 40) -> int:
    """One cluster per 50 rows, within the two bounds."""
    return min(max(k_min, n_rows // 50), k_max)


def choose_k_expr(n_rows: Column, k_min: int = 3, k_max: int = 40) -> Column:
    per_fifty = F.floor(n_rows / F.lit(50))
    return F.least(F.greatest(F.lit(k_min), per_fifty), F.lit(k_max)).cast("int")


def label_number(col: Column) -> Column:
    """A cluster label as an integer; null when it is not a number."""
    return col.cast("string").try_cast("double").try_cast("int")


def labelled(df: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """Rows with a numeric label, as ``cluster_id INT``."""
    require_columns(df, cluster_col)
    label = F.col(cluster_col)
    if not isinstance(df.schema[cluster_col].dataType, T.IntegerType):
        label = label_number(label)
    named = df.withColumn("_label", label).drop(cluster_col).withColumnRenamed("_label", "cluster_id")
    return named.where(F.col("cluster_id").isNotNull())


def cluster_sizes(df: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """Rows per cluster, largest first."""
    require_columns(df, cluster_col)
    sizes = df.groupBy(cluster_col).agg(F.count("*").alias("count"))
    return sizes.orderBy(F.desc("count"), cluster_col)


def cluster_ids(df: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """Distinct numeric labels, ascending."""
    return labelled(df, cluster_col).select("cluster_id").distinct().orderBy("cluster_id")


def centroids(df: DataFrame, cluster_col: str = "cluster_id", vector_col: str = "embedding") -> DataFrame:
    """``(cluster_id, n, centroid)``: mean vector per cluster.

    The mean is built from partial sums, so only one row per cluster and task
    is shuffled, however large a cluster is.
    """
    require_columns(df, cluster_col, vector_col)
    rows = labelled(df, cluster_col).where(F.col(vector_col).isNotNull())
    rows = rows.select("cluster_id", array_to_vector(F.col(vector_col)).alias("v"))
    means = rows.groupBy("cluster_id").agg(
        F.count("*").alias("n"), Summarizer.mean(F.col("v")).alias("m")
    )
    return means.select("cluster_id", "n", vector_to_array("m").alias("centroid"))


def centroid_blocks(points: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A centroid table as ``(ids, matrix)`` blocks of bounded size."""
    for rows in row_blocks(points.select("cluster_id", "centroid"), "cluster_id"):
        yield (
            np.array([r["cluster_id"] for r in rows], dtype=np.int32),
            np.array([r["centroid"] for r in rows], dtype=np.float64),
        )


def assign_nearest(
    df: DataFrame,
    points: DataFrame,
    id_col: str = "id",
    vector_col: str = "embedding",
    keep_vector: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(id, cluster_id, distance)`` of the nearest centroid; ties to the lower id.

    Columns in ``keep`` come along.  Rows without a vector have no cluster and
    are left out.

    The centroids travel to the tasks, so no row is shuffled.  More centroids
    than fit one block are passed over block by block, in the same stage.
    """
    require_columns(df, id_col, vector_col)
    require_columns(points, "cluster_id", "centroid")
    result = df.where(F.col(vector_col).isNotNull()).select(
        F.col(id_col),
        F.lit(None).cast("int").alias("cluster_id"),
        F.lit(None).cast("double").alias("distance"),
        F.col(vector_col).alias("embedding"),
        *keep,
    )
    for (ids, matrix), last in with_last(centroid_blocks(points)):
        # The vectors return from the tasks only where they are needed again.
        names = [c for c in result.columns if keep_vector or not last or c != "embedding"]
        shared = df.sparkSession.sparkContext.broadcast((ids, matrix))
        schema = T.StructType([result.schema[c] for c in names])
        result = result.mapInArrow(_nearest_in_block(shared, names), schema)
    return result if keep_vector else result.select(id_col, "cluster_id", "distance", *keep)


def _nearest_in_block(shared, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, points = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            found, gap = vectors.nearest_point(vectors.matrix(batch.column(3)), points)
            label = ids[found]
            old_label = batch.column(1).fill_null(2**31 - 1).to_numpy(zero_copy_only=False)
            old_gap = batch.column(2).fill_null(np.inf).to_numpy(zero_copy_only=False)
            keep = (old_gap < gap) | ((old_gap == gap) & (old_label < label))
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns["cluster_id"] = pa.array(np.where(keep, old_label, label), pa.int32())
            columns["distance"] = pa.array(np.where(keep, old_gap, gap), pa.float64())
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    return run


def _hash_draw(*parts) -> Column:
    """A number between 0 and 1 that depends on the values only."""
    digest = F.md5(F.concat_ws(":", *parts))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / float(1 << 32)


def _drawn(*parts) -> float:
    """The same number on the driver."""
    return (int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16) + 0.5) / (1 << 32)


def _picked_by_weight(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` of the points, each drawn by its weight times its squared distance to those before."""
    chosen: list[int] = []
    least = np.ones(len(points))
    for step in range(min(k, len(points))):
        along = np.cumsum(weights * least)
        if along[-1] <= 0:
            break
        chosen.append(int(np.searchsorted(along, _drawn(seed, "pick", step) * along[-1], side="right")))
        gap = vectors.exact_distance(points, points[chosen[-1]]) ** 2
        least = gap if step == 0 else np.minimum(least, gap)
    return points[chosen]


def seed_points(
    df: DataFrame,
    k: int,
    random_state: int = 42,
    id_col: str = "id",
    vector_col: str = "embedding",
    rounds: int = 5,
) -> DataFrame:
    """``(cluster_id, centroid)``: up to ``k`` start points, spread over the rows.

    In each round ``2 * k`` rows are drawn with a chance that grows with the
    squared distance to the points so far.  The points drawn, weighted by the
    rows nearest to them, are reduced to ``k`` on the driver, which sees no
    more than ``2 * k * rounds + 1`` rows.  All draws are hashes of seed, round
    and id, so the result does not depend on partitions or on retries.  Fewer
    points come back where there are fewer different vectors.
    """
    require_columns(df, id_col, vector_col)
    spark = df.sparkSession
    rows = df.where(F.col(vector_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector_col).alias("embedding"))
    schema = "cluster_id INT, centroid ARRAY<DOUBLE>"
    draw = _hash_draw(F.lit(random_state), F.lit(0), "id")
    found = [[float(v) for v in r["embedding"]] for r in rows.orderBy(draw, "id").limit(1).collect()]
    if not found:
        return spark.createDataFrame([], schema)

    def placed() -> DataFrame:
        points = spark.createDataFrame(list(enumerate(found)), schema)
        return assign_nearest(rows, points, keep_vector=True)

    for turn in range(1, rounds + 1):
        # The least of such keys are a sample without replacement, by squared distance.
        key = -F.ln(_hash_draw(F.lit(random_state), F.lit(turn), "id")) / F.col("distance") / F.col("distance")
        drawn = placed().where("distance > 0").withColumn("key", key).orderBy("key", "id").limit(2 * k)
        fresh = drawn.select("embedding").collect()
        if not fresh:
            break
        found += [[float(v) for v in r["embedding"]] for r in fresh]
    counts = {r["cluster_id"]: r["count"] for r in placed().groupBy("cluster_id").count().collect()}
    weights = np.array([counts.get(i, 0) for i in range(len(found))], np.float64)
    picked = _picked_by_weight(np.array(found, np.float64), weights, k, random_state)
    return spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(picked)], schema)


def fit_kmeans(
    df: DataFrame,
    k: int | None = None,
    random_state: int = 42,
    id_col: str = "id",
    vector_col: str = "embedding",
    max_iter: int = 300,
    keep: Sequence[str] = (),
    tol: float = 1e-4,
) -> tuple[DataFrame, int]:
    """K-means labels as ``(id, cluster_id)`` and the columns in ``keep``, and the k that was used.

    Start points come from ``seed_points``, then centroids move until none
    moves farther than ``tol``.  The same rows give the same labels, however
    they are partitioned.

    ``df`` should be a stored table: the fit passes over it many times.
    Clusters are numbered by size, the largest first, equal ones by their
    centers.  Rows without a vector keep a null label.
    """
    require_columns(df, id_col, vector_col)
    rows = df.where(F.col(vector_col).isNotNull())
    n_rows = rows.count()
    if n_rows == 0:
        raise ValueError("no rows to cluster")
    k = min(choose_k(n_rows) if k is None else k, n_rows)
    start = seed_points(rows, k, random_state, id_col, vector_col)
    points = stored(lloyd(rows, start, max_iter, id_col, vector_col, tol))
    # Columns of the rows may have the names that the assignment uses.
    whole = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("embedding"), F.struct(id_col, *keep).alias("row"))
    placed = assign_nearest(whole, points, keep=("row",))
    sizes = stored(placed.groupBy("cluster_id").count())
    order = Window.orderBy(F.desc("count"), "centroid")
    # One row per cluster.
    numbers = points.join(sizes, "cluster_id").select("cluster_id", (F.row_number().over(order) - 1).alias("number"))
    labelled_rows = join_small(placed, numbers, "cluster_id", bound=k)
    labels = labelled_rows.select("row.*", F.col("number").cast("int").alias("cluster_id")).select(id_col, "cluster_id", *keep)
    missing = df.where(F.col(vector_col).isNull()).select(
        id_col, F.lit(None).cast("int").alias("cluster_id"), *keep
    )
    return labels.unionByName(missing), k


def lloyd(
    df: DataFrame,
    start: DataFrame,
    iterations: int,
    id_col: str = "id",
    vector_col: str = "embedding",
    tol: float | None = None,
) -> DataFrame:
    """Centroids after a number of k-means steps from given start points.

    ``start`` holds ``(cluster_id, centroid)``; the result adds ``n``, the rows
    each cluster had in the last step.  A cluster that loses all its rows keeps
    its centroid.  With ``tol``, steps end once no centroid moves farther than
    that.  Each step sends one partial sum per cluster and task through the
    shuffle.
    """
    require_columns(df, id_col, vector_col)
    require_columns(start, "cluster_id", "centroid")
    if not is_small(start):
        return _lloyd_on_tables(df, start, iterations, id_col, vector_col, tol)
    rows = df.where(F.col(vector_col).isNotNull()).select(F.col(vector_col).alias("embedding"))
    ids, points = next(centroid_blocks(start))
    place = {label: i for i, label in enumerate(ids.tolist())}
    counts = np.zeros(len(ids), dtype=np.int64)
    for _ in range(iterations):
        shared = df.sparkSession.sparkContext.broadcast((ids, points))
        sums = rows.mapInArrow(
            _partial_sums(shared), "cluster_id INT, n BIGINT, total ARRAY<DOUBLE>"
        )
        merged = (
            sums.select("cluster_id", "n", array_to_vector("total").alias("v"))
            .groupBy("cluster_id")
            .agg(F.sum("n").alias("n"), Summarizer.sum(F.col("v")).alias("total"))
        )
        before, counts, points = points, np.zeros_like(counts), points.copy()
        # At most one row per start point, whatever the size of the table.
        for row in merged.collect():
            i = place[row["cluster_id"]]
            counts[i] = row["n"]
            points[i] = row["total"].toArray() / row["n"]
        if tol is not None and (vectors.exact_distance(points, before) <= tol).all():
            break
    return df.sparkSession.createDataFrame(
        list(zip(ids.tolist(), counts.tolist(), points.tolist(), strict=True)),
        "cluster_id INT, n BIGINT, centroid ARRAY<DOUBLE>",
    )


def _lloyd_on_tables(df, start, iterations, id_col, vector_col, tol) -> DataFrame:
    """The same steps with the centroids kept in a table, for very many clusters."""
    current = start.select("cluster_id", F.lit(0).cast("bigint").alias("n"), "centroid")
    for _ in range(iterations):
        rows = assign_nearest(df, current, id_col, vector_col, keep_vector=True)
        moved = centroids(rows).withColumnsRenamed({"n": "moved_n", "centroid": "moved"})
        current = stored(
            current.join(moved, "cluster_id", "left").select(
                "cluster_id",
                F.coalesce("moved_n", F.lit(0)).alias("n"),
                F.coalesce("moved", "centroid").alias("centroid"),
                vectors.euclidean(F.col("centroid"), F.coalesce("moved", "centroid")).alias("step"),
            )
        )
        if tol is not None and current.where(F.col("step") > tol).isEmpty():
            break
        current = current.drop("step")
    return current.drop("step")


def _partial_sums(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, points = shared.value
        totals = np.zeros_like(points)
        counts = np.zeros(len(ids), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                rows = vectors.matrix(batch.column(0))
                found, _ = vectors.nearest_point(rows, points)
                order = np.argsort(found, kind="stable")
                present, first = np.unique(found[order], return_index=True)
                totals[present] += np.add.reduceat(rows[order], first, axis=0)
                counts += np.bincount(found, minlength=len(ids))
        used = counts > 0
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids[used], pa.int32()),
                pa.array(counts[used], pa.int64()),
                vectors.list_column(totals[used], pa.float64()),
            ],
            names=["cluster_id", "n", "total"],
        )

    return run
