"""Two-dimensional view of the embeddings, and tables to judge the clusters by."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import asdict

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.checks import require_columns
from talkatlas.functions import vectors
from talkatlas.operators.cluster import labelled
from talkatlas.params import ProjectionParams
from talkatlas.runtime import path_exists, publish, row_blocks, with_last


def fit_projection(
    df: DataFrame, params: ProjectionParams | None = None, vector_col: str = "embedding"
) -> Callable[[DataFrame], DataFrame]:
    """Fit principal components; the result adds ``coords`` to rows with a vector.

    Under the cosine metric the vectors are scaled to length one first.  The
    sign of a component is chosen so that its largest loading is positive.
    """
    require_columns(df, vector_col)
    p = params or ProjectionParams()

    def prepared(rows: DataFrame) -> DataFrame:
        rows = rows.where(F.col(vector_col).isNotNull())
        rows = rows.withColumn("_raw", array_to_vector(F.col(vector_col)))
        if p.metric == "cosine":
            return Normalizer(p=2.0, inputCol="_raw", outputCol="_v").transform(rows)
        return rows.withColumn("_v", F.col("_raw"))

    sample = prepared(df.select(vector_col))
    if len(sample.take(2)) < 2:
        raise ValueError("a projection needs at least two rows")
    model = PCA(k=p.n_components, inputCol="_v", outputCol="_pc").fit(sample)
    loadings = model.pc.toArray()
    largest = loadings[np.abs(loadings).argmax(axis=0), range(p.n_components)]
    signs = np.where(largest < 0, -1.0, 1.0).tolist()

    def add_coords(rows: DataFrame) -> DataFrame:
        scores = vector_to_array("_pc")
        oriented = F.array(*[scores[i] * F.lit(s) for i, s in enumerate(signs)])
        projected = model.transform(prepared(rows)).withColumn("coords", oriented)
        return projected.drop("_raw", "_v", "_pc")

    return add_coords


def project(
    df: DataFrame,
    params: ProjectionParams | None = None,
    id_col: str = "id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``(id, coords)``: the projected vectors."""
    require_columns(df, id_col, vector_col)
    return fit_projection(df, params, vector_col)(df.select(id_col, vector_col)).drop(vector_col)


def project_and_merge(
    df: DataFrame,
    params: ProjectionParams | None = None,
    id_col: str = "id",
    vector_col: str = "embedding",
    x_col: str = "x",
    y_col: str = "y",
    cache_dir: str | None = None,
) -> DataFrame:
    """The rows with two coordinate columns; ``cache_dir`` keeps and reuses them.

    Without a cache the columns are added in place, so nothing is shuffled.
    Rows without a vector keep null coordinates.
    """
    p = params or ProjectionParams()
    if p.n_components < 2:
        raise ValueError("two coordinate columns need at least two components")
    require_columns(df, id_col, vector_col)
    if cache_dir is None:
        missing = df.where(F.col(vector_col).isNull())
        rows = fit_projection(df, p, vector_col)(df)
        rows = rows.unionByName(missing.withColumn("coords", F.lit(None).cast("array<double>")))
    else:
        rows = df.join(cached_projection(df, p, cache_dir, id_col, vector_col), id_col, "left")
    axes = {x_col: F.get("coords", F.lit(0)), y_col: F.get("coords", F.lit(1))}
    return rows.withColumns(axes).drop("coords")


def input_digest(df: DataFrame, id_col: str = "id", vector_col: str = "embedding") -> DataFrame:
    """One row ``(n_rows, digest)`` that depends on the content, not on the order."""
    row_hash = F.xxhash64(id_col, vector_col).cast("decimal(38,0)")
    return df.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(row_hash), F.lit(0)).cast("string").alias("digest"),
    )


def cached_projection(
    df: DataFrame,
    params: ProjectionParams,
    cache_dir: str,
    id_col: str = "id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``project``, stored under ``cache_dir`` and read back while nothing changed.

    An entry belongs to one set of parameters and one input content.  It is
    written beside its place and moved there whole, so no reader sees an
    unfinished one; of several writers one wins, and the others use its entry.
    """
    spark = df.sparkSession
    seen = input_digest(df, id_col, vector_col).first()
    record = spark.createDataFrame([(seen["n_rows"], seen["digest"])], "n_rows BIGINT, digest STRING")
    for name, value in asdict(params).items():
        record = record.withColumn(name, F.lit(value).cast("string"))
    everything = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    key = record.select(F.sha2(everything, 256)).first()[0]
    entry = f"{cache_dir}/{key}"
    if not path_exists(spark, entry):
        own = f"{cache_dir}/.writing-{uuid.uuid4().hex}"
        project(df, params, id_col, vector_col).write.parquet(f"{own}/coords")
        record.write.json(f"{own}/params")
        publish(spark, own, entry)
    return spark.read.parquet(f"{entry}/coords")


def projection_bins(
    projected: DataFrame,
    width: float,
    cluster_col: str = "cluster_id",
    x_col: str = "x",
    y_col: str = "y",
) -> DataFrame:
    """Rows per cluster and square of the plane: a scatter plot as a table."""
    require_columns(projected, cluster_col, x_col, y_col)
    bin_of = {"x_bin": x_col, "y_bin": y_col}
    return projected.groupBy(
        cluster_col, *[F.floor(F.col(c) / F.lit(width)).alias(b) for b, c in bin_of.items()]
    ).agg(F.count("*").alias("count"))


def silhouette(
    df: DataFrame, cluster_col: str = "cluster_id", vector_col: str = "embedding"
) -> DataFrame:
    """``(cluster_id, n, silhouette)``: how well each cluster is separated.

    Cosine distance.  The mean distance of a row to all rows of a cluster
    follows from the mean of their unit vectors, so no pairs of rows are made.
    A cluster of one row scores 0, and so does the only cluster there is.
    """
    require_columns(df, cluster_col, vector_col)
    rows = labelled(df, cluster_col).where(F.col(vector_col).isNotNull())
    rows = rows.select("cluster_id", F.col(vector_col).alias("embedding"))
    scaled = Normalizer(p=2.0, inputCol="v", outputCol="unit").transform(
        rows.select("cluster_id", array_to_vector("embedding").alias("v"))
    )
    means = scaled.groupBy("cluster_id").agg(
        F.count("*").alias("n"), Summarizer.mean(F.col("unit")).alias("m")
    )
    means = means.select("cluster_id", "n", vector_to_array("m").alias("m"))
    scores = rows.select(
        "cluster_id",
        F.lit(None).cast("double").alias("own"),
        F.lit(None).cast("double").alias("other"),
        "embedding",
    )
    for block, last in with_last(row_blocks(means, "cluster_id")):
        names = scores.columns[:3] if last else scores.columns
        schema = T.StructType([scores.schema[c] for c in names])
        shared = df.sparkSession.sparkContext.broadcast(
            (
                np.array([r["cluster_id"] for r in block]),
                np.array([r["n"] for r in block], dtype=np.float64),
                np.array([r["m"] for r in block]),
            )
        )
        scores = scores.mapInArrow(_mean_distances(shared, names), schema)
    widest = F.greatest("own", "other")
    score = F.when(widest > 0, (F.col("other") - F.col("own")) / widest)
    return scores.groupBy("cluster_id").agg(
        F.count("*").alias("n"), F.avg(F.coalesce(score, F.lit(0.0))).alias("silhouette")
    )


def _mean_distances(shared, names: list[str]):
    """Mean distance to the own cluster, and to the nearest other one.

    Both are null where there is nothing to compare with.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, means = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            units = vectors.unit_rows(vectors.matrix(batch.column(3)))
            gaps = 1.0 - units @ means.T
            is_own = batch.column(0).to_numpy(zero_copy_only=False)[:, None] == ids[None, :]
            row, place = np.nonzero(is_own)
            own = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            # The mean distance includes the row itself; take it out again.
            itself = 1.0 - (units[row] * units[row]).sum(axis=1)
            n = sizes[place]
            own[row] = np.divide(
                n * gaps[row, place] - itself, n - 1, out=np.full(len(n), np.nan), where=n > 1
            )
            gaps[is_own] = np.inf
            other = batch.column(2).fill_null(np.inf).to_numpy(zero_copy_only=False)
            other = np.minimum(other, gaps.min(axis=1))
            columns = [
                batch.column(0),
                pa.array(own, pa.float64(), mask=np.isnan(own)),
                pa.array(other, pa.float64(), mask=np.isinf(other)),
                batch.column(3),
            ]
            yield pa.RecordBatch.from_arrays(columns[: len(names)], names=names)

    return run
