"""Nearest neighbours of every row, exact or approximate, without comparing everything.

Exact: rows are assigned to the nearest of a bounded number of pivots.  From the cell
radii follows an upper bound on the neighbour distance within a cell, and a row
is sent only to the groups of cells that it can matter to, and within a task is
compared only with the cells themselves.  Groups are cut into blocks of bounded
size on both sides, so a dense cell is many tasks.

Approximate: rows meet in the buckets of random projections, and a full bucket
is compared block by block as well.  Where the buckets together hold more pairs
than the table, each pair is compared once instead, and only those that share a
bucket count.  In both, identical vectors are compared once, whatever their number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.checks import require_columns
from talkatlas.functions import vectors
from talkatlas.runtime import stored, salt_count, top_n_per_group

MAX_PIVOTS = 1024
# Small tables have several cells as well, so that the bounds are at work there.
MIN_PIVOTS = 16
# Rows travel once per group of cells and once per block, so both are as few as keep the tasks
# busy and a block at about this many components.
MIN_GROUPS = 16
BLOCK_COMPONENTS = 4_000_000
# Beyond this share of all pairs in buckets, repeats counted, each pair is compared once instead.
MOST_BUCKET_PAIRS = 1.0
# Rows or pairs whose bounds or keys are compared in one go.
ROUTE_SLICE = 65_536
MAX_HOT_KEYS = 10_000
MIN_HOT_COPIES = 1000


def nearest_neighbors(
    df: DataFrame,
    k: int = 15,
    metric: str = "cosine",
    id_col: str = "id",
    vector_col: str = "embedding",
    block_rows: int = 2048,
) -> DataFrame:
    """``(id, neighbor_id, distance, rank)``: the ``k`` nearest other rows.

    Equal distances are ordered by id.  A zero vector is at cosine distance 1
    from everything.  The work falls with the number of cells that the bounds
    rule out; on data without structure it is that of comparing all blocks.
    A cell has about ``block_rows`` rows, as long as ``MAX_PIVOTS`` allows.
    """
    return _neighbors(df, k, metric, id_col, vector_col, partial(_search, block_rows=block_rows))


def approximate_neighbors(
    df: DataFrame,
    k: int = 15,
    metric: str = "cosine",
    id_col: str = "id",
    vector_col: str = "embedding",
    tables: int = 12,
    projections: int = 2,
    bucket_length: float = 0.2,
    seed: int = 42,
    block_rows: int | None = None,
) -> DataFrame:
    """``(id, neighbor_id, distance, rank)``: the ``k`` nearest rows among those that share a bucket.

    Each of ``tables`` keys a row by ``projections`` random projections, cut
    into steps of ``bucket_length``; under cosine vectors have length one.  More
    tables, fewer projections and longer steps find more at more cost.  All rows
    of a bucket are compared, whatever its size, in blocks of ``block_rows`` (by
    default of ``BLOCK_COMPONENTS`` components), so
    distances, ties and zero vectors are as in ``nearest_neighbors``; only rows
    that meet nowhere are missed, and a list can be shorter than ``k``.
    """
    search = partial(
        _hashed_search,
        tables=tables,
        projections=projections,
        bucket_length=bucket_length,
        seed=seed,
        block_rows=block_rows,
    )
    return _neighbors(df, k, metric, id_col, vector_col, search)


def recall(found: DataFrame, exact: DataFrame, id_col: str = "id") -> DataFrame:
    """One row ``(n_exact, n_found, recall)``: the share of the exact pairs that were found."""
    pair = [id_col, "neighbor_id"]
    hit = exact.select(*pair).join(found.select(*pair, F.lit(1).alias("hit")), pair, "left")
    sums = hit.agg(F.count("*").alias("n_exact"), F.count("hit").alias("n_found"))
    return sums.withColumn("recall", F.col("n_found") / F.nullif(F.col("n_exact"), F.lit(0)))


def _neighbors(df: DataFrame, k: int, metric: str, id_col: str, vector_col: str, search) -> DataFrame:
    """Neighbours by a search over the different vectors; copies and zero vectors are put back here."""
    require_columns(df, id_col, vector_col)
    if metric not in ("cosine", "euclidean"):
        raise ValueError(f"unknown metric: {metric}")
    source = df.where(F.col(vector_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(vector_col).alias("embedding")
    )
    id_type = source.schema["id"].dataType
    keys = stored(
        source.mapInArrow(
            _content_keys(metric), T.StructType([source.schema["id"], T.StructField("key", T.StringType())])
        )
    )
    groups = stored(_copy_groups(keys.where(F.col("key").isNotNull()), k))
    distinct = source.join(
        groups.select(F.get("ids", F.lit(0)).alias("id"), "ids"), "id"
    )
    found = search(distinct, k, metric)
    lists = groups.join(found, F.get(groups["ids"], F.lit(0)) == found["qid"]).select(
        "key", "copies", "near"
    )
    # Rows without a key share no group, so they stay out of the join.
    unkeyed = keys.where(F.col("key").isNull())
    rows = _spread_join(keys.where(F.col("key").isNotNull()), lists)
    rows = rows.unionByName(unkeyed.select("id", "key", F.lit(None).cast(rows.schema["near"].dataType).alias("near")))

    # Zero vectors take no part in the search: their distances are all 1.
    zeros = [
        F.struct(F.lit(1.0).alias("distance"), F.lit(r["id"]).cast(id_type).alias("id"))
        for r in keys.where(F.col("key").isNull()).orderBy("id").limit(k + 1).collect()
    ]
    if zeros:
        every = [
            F.struct(F.lit(1.0).alias("distance"), F.lit(r["id"]).cast(id_type).alias("id"))
            for r in keys.orderBy("id").limit(k + 1).collect()
        ]
        empty = F.array().cast(rows.schema["near"].dataType)
        near = F.concat(F.coalesce("near", empty), F.array(*zeros))
        rows = rows.withColumn("near", F.when(F.col("key").isNull(), F.array(*every)).otherwise(near))
    others = F.filter("near", lambda n: n["id"] != F.col("id"))
    best = F.slice(F.array_sort(others), 1, k)
    return rows.select("id", F.posexplode(best).alias("place", "n")).select(
        F.col("id").alias(id_col),
        F.col("n.id").alias("neighbor_id"),
        F.col("n.distance").alias("distance"),
        (F.col("place") + 1).alias("rank"),
    )


def _in_space(column: pa.Array, metric: str) -> np.ndarray:
    values = vectors.matrix(column)
    return vectors.unit_rows(values) if metric == "cosine" else values


def _content_keys(metric: str):
    """A key that equal vectors share; null for a zero vector under cosine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = _in_space(batch.column(1), metric) + 0.0
                usable = rows.any(axis=1) | (metric != "cosine")
                # Only the different rows of a batch are hashed.
                packed = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.itemsize * rows.shape[1])))
                known, place = np.unique(packed.ravel(), return_inverse=True)
                digest = np.array([hashlib.sha256(row.tobytes()).hexdigest() for row in known], object)
                keys = np.where(usable, digest[place], None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(keys, pa.string())], names=["id", "key"]
                )

    return run


def _copy_groups(keys: DataFrame, k: int) -> DataFrame:
    """``(key, copies, ids)``: count and the first ``k + 1`` ids of equal vectors.

    No list of neighbours can hold more of them than that.
    """
    first = top_n_per_group(keys, "key", [F.asc("id")], k + 1, rank="copy")
    ids = first.groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return keys.groupBy("key").agg(F.count("*").alias("copies")).join(ids, "key")


def _spread_join(keys: DataFrame, lists: DataFrame) -> DataFrame:
    """Every row with the list of its vector; frequent vectors are salted.

    A key counts as frequent from ``MIN_HOT_COPIES`` rows and from one part in
    ``MAX_HOT_KEYS`` of all rows, so there are at most that many to broadcast.
    """
    limit = max(keys.count() // MAX_HOT_KEYS, MIN_HOT_COPIES)
    salts = salt_count(keys.sparkSession)
    lists = stored(lists)
    hot = lists.where(F.col("copies") > limit).select("key", F.lit(True).alias("hot"))
    rows = keys.join(F.broadcast(hot), "key", "left")
    rows = rows.withColumn(
        "salt",
        F.when(F.col("hot"), F.pmod(F.spark_partition_id(), F.lit(salts))).otherwise(F.lit(0)),
    )
    copied = F.when(F.col("copies") > limit, F.sequence(F.lit(0), F.lit(salts - 1)))
    lists = lists.withColumn("salt", F.explode(F.coalesce(copied, F.array(F.lit(0)))))
    return rows.join(lists, ["key", "salt"], "left").select("id", "key", "near")


def _search(distinct: DataFrame, k: int, metric: str, block_rows: int) -> DataFrame:
    """``(qid, near)``: the nearest ids of each distinct vector, itself included."""
    spark = distinct.sparkSession
    n_rows = distinct.count()
    n_pivots = min(MAX_PIVOTS, max(1, n_rows // block_rows, min(MIN_PIVOTS, n_rows // 20)))
    chosen = distinct.orderBy(F.md5(F.col("id").cast("string")), "id").limit(n_pivots)
    # At most MAX_PIVOTS rows come to the driver here.
    picked = np.array([r["embedding"] for r in chosen.select("embedding").collect()], dtype=np.float64)
    if not len(picked):
        picked = np.zeros((1, 1))
    pivots = vectors.unit_rows(picked) if metric == "cosine" else picked
    shared = spark.sparkContext.broadcast(pivots)
    in_cells = T.StructType(
        [T.StructField("cell", T.IntegerType()), T.StructField("reach", T.DoubleType()), *distinct.schema]
    )
    queries = stored(
        distinct.select("id", "embedding", "ids").mapInArrow(_assign_cells(shared, metric), _ordered(in_cells))
    )
    radius, sizes, theta = _cell_bounds(queries, pivots, k)
    n_groups = max(MIN_GROUPS, spark.sparkContext.defaultParallelism)
    group = _cell_groups(pivots, sizes, -(-n_rows // n_groups))

    limits = spark.sparkContext.broadcast((pivots, radius + theta, group))
    # Counted and compared from one table, so that rows are routed once.
    routed = stored(
        queries.mapInArrow(
            _route(limits, metric),
            T.StructType([T.StructField("groups", T.ArrayType(T.IntegerType())), *_ordered(in_cells).fields[2:]]),
        )
    )
    met = routed.select(F.explode("groups").alias("group")).groupBy("group").count()
    counts = {r["group"]: r["count"] for r in met.collect()}
    most = _block_rows(pivots.shape[1])
    asking = np.bincount(group, weights=sizes)
    query_parts = [max(1, -(-int(n) // most)) for n in asking]
    row_parts = [max(1, -(-counts.get(g, 0) // most)) for g in range(len(asking))]

    def parts_of(parts):
        return F.element_at(F.lit(parts), F.col("group") + 1)

    def split(side, own, own_parts, other, other_parts):
        """Number the blocks of this side and copy a row to all blocks of the other."""
        own_block = F.pmod(F.xxhash64("id"), parts_of(own_parts).cast("bigint"))
        other_blocks = F.sequence(F.lit(0), parts_of(other_parts) - 1)
        return side.withColumn(own, own_block.cast("int")).withColumn(other, F.explode(other_blocks))

    of_cell = F.element_at(F.lit(group.tolist()), F.col("cell") + 1)
    left = split(queries.select(of_cell.alias("group"), "id", "embedding", "cell"), "qb", query_parts, "rb", row_parts)
    right = split(routed.select(F.explode("groups").alias("group"), "id", "embedding", "ids"), "rb", row_parts, "qb", query_parts)
    return _best_of_blocks(distinct, left, right, ["group", "qb", "rb"], k, metric, _nearest_by_cell(limits, metric))


def _block_rows(width: int) -> int:
    return max(1, BLOCK_COMPONENTS // max(width, 1))


def _cell_groups(pivots: np.ndarray, sizes: np.ndarray, most: int) -> np.ndarray:
    """A group for each cell: neighbouring cells, until they have ``most`` rows together."""
    group = np.full(len(pivots), -1)
    for number in range(len(pivots)):
        left = np.flatnonzero(group < 0)
        if not len(left):
            break
        near = left[np.argsort(vectors.exact_distance(pivots[left], pivots[left[0]]), kind="stable")]
        taken = np.searchsorted(np.cumsum(sizes[near]), most) + 1
        group[near[:taken]] = number
    return group


def _best_of_blocks(
    distinct: DataFrame, left: DataFrame, right: DataFrame, where: list[str], k: int, metric: str, nearest=None
) -> DataFrame:
    """``(qid, near)`` from all pairs of blocks, whose numbers are the columns ``where``.

    ``nearest`` finds the rows of one block for the queries of another; by
    default it is ``vectors.nearest_rows`` on their vectors.
    """
    id_field = T.StructField("qid", distinct.schema["id"].dataType)
    out = T.StructType(
        [
            id_field,
            T.StructField("distance", T.DoubleType()),
            T.StructField("ids", distinct.schema["ids"].dataType),
        ]
    )
    pairs = (
        left.groupBy(*where)
        .cogroup(right.groupBy(*where))
        .applyInArrow(_compare_blocks(k, metric, nearest or _nearest_of_all), out)
    )
    # The same two vectors may have met more than once, at the same distance.  One shuffle serves all that follows.
    pairs = pairs.repartition("qid").groupBy("qid", F.get("ids", F.lit(0)).alias("first")).agg(F.min("distance").alias("distance"), F.min("ids").alias("ids"))
    order = Window.partitionBy("qid").orderBy("distance", "first")
    best = pairs.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    named = F.transform("ids", lambda i: F.struct(F.col("distance").alias("distance"), i.alias("id")))
    # At most (k + 1) squared entries: k + 1 vectors with k + 1 ids each.
    return best.groupBy("qid").agg(F.flatten(F.collect_list(named)).alias("near"))


def _hashed_search(
    distinct: DataFrame,
    k: int,
    metric: str,
    tables: int,
    projections: int,
    bucket_length: float,
    seed: int,
    block_rows: int | None,
) -> DataFrame:
    """``(qid, near)``: the nearest ids of each distinct vector among the vectors of its buckets."""
    rows = stored(distinct.select("id", "embedding", "ids", array_to_vector("embedding").alias("v")))
    scaled = Normalizer(p=2.0, inputCol="v", outputCol="x").transform(rows) if metric == "cosine" else rows.withColumnRenamed("v", "x")
    if rows.isEmpty():
        return _no_neighbors(distinct)
    model = BucketedRandomProjectionLSH(
        inputCol="x", outputCol="hashes", bucketLength=bucket_length, numHashTables=tables * projections, seed=seed
    ).fit(scaled)
    steps = F.transform("hashes", lambda h: F.get(vector_to_array(h), F.lit(0)))
    hashed = model.transform(scaled).select("id", "embedding", "ids", steps.alias("steps"))
    keys = [
        F.xxhash64(F.lit(t), *(F.get("steps", F.lit(t * projections + p)) for p in range(projections)))
        for t in range(tables)
    ]
    entries = stored(hashed.select("id", "embedding", "ids", F.array(*keys).alias("keys")))
    members = entries.select("id", F.explode("keys").alias("bucket"))
    most = block_rows or _block_rows(len(rows.first()["embedding"]))
    # Buckets of one row find nothing, but a row always finds itself and its copies.
    blocks = F.ceil(F.col("n") / F.lit(most)).cast("int").alias("blocks")
    buckets = stored(members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket", "n", blocks))
    n_rows = entries.count()
    held = buckets.agg(F.sum(F.col("n").cast("double") * F.col("n"))).first()[0] or 0.0
    # An id with several vectors meets rows in the buckets of each, so it needs the join by id.
    if held > MOST_BUCKET_PAIRS * n_rows * n_rows and entries.select("id").distinct().count() == n_rows:
        left, right = _grid(entries, n_rows, most)
        met = _best_of_blocks(distinct, left, right, ["qb", "rb"], k, metric, _nearest_sharing)
    else:
        # Keys and block numbers first; vectors join those that meet something.
        own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
        placed = members.join(buckets.drop("n"), "bucket").withColumn("own", own)
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        asks = placed.select("id", "bucket", F.col("own").alias("qb"), other.alias("rb"))
        offers = placed.select("id", "bucket", F.col("own").alias("rb"), other.alias("qb"))
        left = asks.join(entries.select("id", "embedding"), "id").select("bucket", "qb", "rb", "id", "embedding")
        right = offers.join(entries.select("id", "embedding", "ids"), "id")
        # Both sides come from one table, so the columns of this one get a name of their own.
        right = right.select(*(F.col(c).alias(c) for c in ("bucket", "qb", "rb", "id", "embedding", "ids")))
        met = _best_of_blocks(distinct, left, right, ["bucket", "qb", "rb"], k, metric)
    itself = F.transform("ids", lambda i: F.struct(F.lit(0.0).alias("distance"), i.alias("id")))
    alone = entries.join(met.select(F.col("qid").alias("id")), "id", "left_anti").select(F.col("id").alias("qid"), itself.alias("near"))
    return met.unionByName(alone)


def _grid(entries: DataFrame, n_rows: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Queries and rows in blocks of at most about ``most`` rows, each block of one side with all of the other."""
    row_parts = -(-n_rows // most)
    query_parts = max(row_parts, MIN_GROUPS, entries.sparkSession.sparkContext.defaultParallelism)

    def dealt(own, own_parts, other, other_parts):
        block = F.pmod(F.xxhash64("id"), F.lit(own_parts)).cast("int").alias(own)
        return [block, F.explode(F.sequence(F.lit(0), F.lit(other_parts - 1))).alias(other)]

    left = entries.select(*dealt("qb", query_parts, "rb", row_parts), "id", "embedding", "keys")
    right = entries.select(*dealt("rb", row_parts, "qb", query_parts), "id", "embedding", "ids", "keys")
    return left, right


def _no_neighbors(distinct: DataFrame) -> DataFrame:
    itself = F.transform("ids", lambda i: F.struct(F.lit(0.0).alias("distance"), i.alias("id")))
    return distinct.select(F.col("id").alias("qid"), itself.alias("near"))


def _ordered(schema: T.StructType) -> T.StructType:
    """cell, reach, id, embedding, ids: the column order inside the tasks."""
    return T.StructType([schema[c] for c in ("cell", "reach", "id", "embedding", "ids")])


def _assign_cells(shared, metric: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell, reach = vectors.nearest_point(_in_space(batch.column(1), metric), shared.value)
                columns = [pa.array(cell.astype(np.int32)), pa.array(reach), *batch.columns]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["cell", "reach", "id", "embedding", "ids"]
                )

    return run


def _cell_bounds(queries: DataFrame, pivots: np.ndarray, k: int):
    """Radius, size and neighbour-distance bound of each cell.

    A row of a cell finds ``k + 1`` rows no farther away than radius plus pivot
    distance plus the rows' own pivot distances.
    """
    radius = np.zeros(len(pivots))
    sizes = np.zeros(len(pivots), dtype=np.int64)
    stats = queries.groupBy("cell").agg(F.max("reach").alias("radius"), F.count("*").alias("n"))
    for row in stats.collect():
        radius[row["cell"]], sizes[row["cell"]] = row["radius"], row["n"]
    near = np.full((len(pivots), k + 1), np.inf)
    closest = top_n_per_group(
        queries.select("cell", "reach", "id"), "cell", [F.asc("reach"), F.asc("id")], k + 1
    )
    for row in closest.select("cell", "reach", "rank").collect():
        near[row["cell"], row["rank"] - 1] = row["reach"]
    theta = np.empty(len(pivots))
    for i, pivot in enumerate(pivots):
        gaps = vectors.exact_distance(pivots, pivot)
        bounds = (radius[i] + gaps[:, None] + near).ravel()
        theta[i] = np.partition(bounds, k)[k]
    return radius, sizes, theta


def _route(limits, metric: str):
    """The groups of cells whose queries a row may be a neighbour of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, reachable, group = limits.value
        order = np.argsort(group, kind="stable")
        starts = np.searchsorted(group[order], np.arange(group.max() + 1))
        for batch in batches:
            if not batch.num_rows:
                continue
            wanted = _within_reach(_in_space(batch.column(3), metric), pivots, reachable)
            wanted = np.logical_or.reduceat(wanted[:, order], starts, axis=1)
            row, number = np.nonzero(wanted)
            offsets = np.concatenate([[0], np.cumsum(wanted.sum(axis=1))])
            groups = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(number, pa.int32())
            )
            yield pa.RecordBatch.from_arrays(
                [groups, batch.column(2), batch.column(3), batch.column(4)],
                names=["groups", "id", "embedding", "ids"],
            )

    return run


def _within_reach(rows: np.ndarray, pivots: np.ndarray, reachable: np.ndarray) -> np.ndarray:
    """Which rows may be neighbours of queries of the cells of these pivots."""
    sq, slack = vectors.squared_screen(rows, pivots)
    gaps = np.sqrt(np.maximum(sq - slack[:, None], 0.0))
    return gaps <= reachable * (1 + vectors.SCREEN_TOLERANCE)


def _nearest_of_all(left: pa.Table, right: pa.Table, queries: np.ndarray, rows: np.ndarray, k: int):
    return vectors.nearest_rows(queries, rows, k)


def _nearest_by_cell(limits, metric: str):
    """The nearest rows among those that the bounds of a query's cell leave open."""

    def run(left: pa.Table, right: pa.Table, queries: np.ndarray, rows: np.ndarray, k: int):
        pivots, reachable, _ = limits.value
        cells = left["cell"].to_numpy()
        found = []
        for cell in np.unique(cells):
            own = np.flatnonzero(cells == cell)
            near = np.concatenate(
                [
                    at + np.flatnonzero(_within_reach(rows[at : at + ROUTE_SLICE], pivots[[cell]], reachable[[cell]])[:, 0])
                    for at in range(0, len(rows), ROUTE_SLICE)
                ]
            )
            if len(near):
                open_rows = rows if len(near) == len(rows) else rows[near]
                asked, taken, distance = vectors.nearest_rows(queries[own], open_rows, k)
                found.append((own[asked], near[taken], distance))
        if not found:
            return np.empty(0, int), np.empty(0, int), np.empty(0)
        return tuple(np.concatenate(part) for part in zip(*found, strict=True))

    return run


def _nearest_sharing(left: pa.Table, right: pa.Table, queries: np.ndarray, rows: np.ndarray, k: int):
    """The nearest rows among those that share a bucket with the query."""
    own, offered = _key_matrix(left["keys"]), _key_matrix(right["keys"])
    # Where buckets hold much of the table, twice as many nearest rows nearly always hold enough that share one.
    asked, taken, distance = vectors.nearest_rows(queries, rows, 2 * k)
    shares = np.concatenate(
        [
            (own[asked[at : at + ROUTE_SLICE]] == offered[taken[at : at + ROUTE_SLICE]]).any(axis=1)
            for at in range(0, len(asked), ROUTE_SLICE)
        ]
    )
    asked, taken, distance = asked[shares], taken[shares], distance[shares]
    settled = (np.bincount(asked, minlength=len(queries)) >= k) | (len(rows) <= 2 * k)
    kept = settled[asked] & (np.arange(len(asked)) - np.searchsorted(asked, asked) < k)
    found = [(asked[kept], taken[kept], distance[kept])]
    by_table = np.ascontiguousarray(offered.T)
    for query in np.flatnonzero(~settled):
        near = np.flatnonzero(np.logical_or.reduce([keys == key for keys, key in zip(by_table, own[query], strict=True)]))
        if len(near):
            _, place, gap = vectors.nearest_rows(queries[[query]], rows[near], k)
            found.append((np.full(len(place), query), near[place], gap))
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def _key_matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1)


def _compare_blocks(k: int, metric: str, nearest):
    """The ``k + 1`` nearest vectors of one block for each query of another."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        column = left["embedding"].combine_chunks() if left.num_rows else None
        if column is None or not right.num_rows:
            ids_type = right.schema.field("ids").type
            return pa.table(
                {
                    "qid": pa.array([], left.schema.field("id").type),
                    "distance": pa.array([], pa.float64()),
                    "ids": pa.array([], ids_type),
                }
            )
        right = right.sort_by("id")
        queries = _in_space(column, metric)
        rows = _in_space(right["embedding"].combine_chunks(), metric)
        # Rows are sorted by id, so equal distances go by id.
        asked, taken, distance = nearest(left, right, queries, rows, k + 1)
        if metric == "cosine":
            distance = 0.5 * distance * distance
        return pa.table(
            {
                "qid": left["id"].take(pa.array(asked)),
                "distance": distance,
                "ids": right["ids"].take(pa.array(taken)),
            }
        )

    return run
