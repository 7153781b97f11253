"""Parents of clusters: agglomerative grouping by cosine distance of centroids.

Groups are merged in rounds.  In each round every group looks up its nearest
other group, and all groups that are nearest to each other merge at once.  For
average, single and complete linkage this gives the same groups as merging one
pair at a time, in a number of rounds that grows slowly.

All linkages keep one row per group or cluster: the mean cosine distance of two
groups follows from their sums of unit vectors, the least distance from the
nearest row of another group.  For the greatest distance, bounds from centres,
radii and a few outer members leave few pairs of groups open, and only those
are worked out from their members.

For many thousands of clusters there is a tree that is split from the top.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas import schemas
from talkatlas.checks import require_columns
from talkatlas.functions import vectors
from talkatlas.operators.cluster import centroid_blocks, centroids
from talkatlas.params import HierarchyParams
from talkatlas.runtime import join_small, row_blocks, stored

# Members of a group that bound its distances, and groups that are compared at once.
OUTER_MEMBERS = 4
GROUP_BLOCK = 1024
# Room for rounding, so that a bound never rules out what it should not.
BOUND_SLACK = 1e-9


def centroid_distances(points: DataFrame) -> DataFrame:
    """``(a, b, distance)`` with a < b: cosine distance of every two centroids.

    The table of all pairs is the result here, one row per two clusters.  It is
    filled block by block from matrix products, without a join.
    """
    require_columns(points, "cluster_id", "centroid")
    own = points.select("cluster_id", "centroid")
    parts = []
    for ids, matrix in centroid_blocks(points):
        shared = points.sparkSession.sparkContext.broadcast((ids, vectors.unit_rows(matrix)))
        parts.append(own.mapInArrow(_pairs_with(shared), "a INT, b INT, distance DOUBLE"))
    if not parts:
        return points.sparkSession.createDataFrame([], "a INT, b INT, distance DOUBLE")
    pairs = parts[0]
    for part in parts[1:]:
        pairs = pairs.unionAll(part)
    return pairs


def _pairs_with(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, units = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            left = batch.column(0).to_numpy(zero_copy_only=False)
            rows = vectors.unit_rows(vectors.matrix(batch.column(1)))
            for label, row in zip(left, rows, strict=True):
                above = ids > label
                gap = np.clip(1.0 - units[above] @ row, 0.0, 2.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(gap), label, dtype=np.int32)),
                        pa.array(ids[above]),
                        pa.array(gap),
                    ],
                    names=["a", "b", "distance"],
                )

    return run


def group_clusters(points: DataFrame, params: HierarchyParams | None = None) -> DataFrame:
    """``(cluster_id, parent_id)``.

    Without ``n_parents`` and ``distance_threshold`` all clusters share parent
    0.  With a threshold, groups at that distance or farther stay apart.
    Parents are numbered by their smallest child.
    """
    p = params or HierarchyParams()
    if p.n_parents is None and p.distance_threshold is None:
        return points.select("cluster_id", F.lit(0).alias("parent_id"))
    points = stored(points)
    n_clusters = points.count()
    if p.linkage == "divisive":
        return _numbered_by_smallest_child(_split_from_the_top(points, min(p.n_parents, n_clusters), p.random_state))
    merges = _group_rounds(points, n_clusters, p.linkage, p.distance_threshold)
    labels = points.select("cluster_id", F.col("cluster_id").alias("label"))
    if merges:
        every = merges[0]
        for merged in merges[1:]:
            every = every.unionByName(merged)
        if p.n_parents is not None:
            lowest = every.orderBy("height", "round", "kept")
            every = lowest.limit(max(n_clusters - p.n_parents, 0))
        labels = _last_labels(points, every, len(merges))
    return _numbered_by_smallest_child(labels)


def _last_labels(points: DataFrame, merges: DataFrame, n_rounds: int) -> DataFrame:
    """``(cluster_id, label)`` after all merges.

    Each cluster points to the group it went into, at most one step per round.
    Joining the table to itself doubles the steps taken.
    """
    steps = merges.select(F.col("gone").alias("cluster_id"), "kept")
    links = stored(
        points.join(steps, "cluster_id", "left").select(
            "cluster_id", F.coalesce("kept", "cluster_id").alias("label")
        )
    )
    for _ in range(n_rounds.bit_length()):
        ahead = links.select(F.col("cluster_id").alias("label"), F.col("label").alias("next"))
        links = stored(
            links.join(ahead, "label").select("cluster_id", F.col("next").alias("label"))
        )
    return links


def _numbered_by_smallest_child(labels: DataFrame) -> DataFrame:
    # A group's label is its smallest cluster id, so labels sort like smallest
    # children.  The unpartitioned window sees one row per parent.
    order = Window.orderBy("label")
    numbers = labels.select("label").distinct().select(
        "label", (F.row_number().over(order) - 1).alias("parent_id")
    )
    return labels.join(numbers, "label").select("cluster_id", "parent_id")


def _group_rounds(
    points: DataFrame, n_clusters: int, linkage: str, threshold: float | None
) -> list[DataFrame]:
    """Merges ``(kept, gone, height, round)``, one table per round.

    The state has one row per group with the sum of its unit vectors for
    average linkage, one row per cluster otherwise; either way no more rows
    than clusters.
    """
    nearest = _nearest_by_farthest_pair if linkage == "complete" else _nearest_groups
    own = points.select("cluster_id", "centroid").mapInArrow(
        _unit_vectors, "label INT, n BIGINT, total ARRAY<DOUBLE>"
    )
    state = stored(own.withColumn("height", F.lit(0.0)))
    rounds: list[DataFrame] = []
    n_merged = 0
    while n_merged < n_clusters - 1:
        merged = stored(_mutual_groups(nearest(state), threshold)).withColumn("round", F.lit(len(rounds)))
        found = merged.count()
        if not found:
            break
        n_merged += found
        rounds.append(merged.select("kept", "gone", "height", "round"))
        moves = merged.select(F.explode(F.array("kept", "gone")).alias("label"), F.col("kept").alias("to"), F.col("height").alias("raised"))
        moved = join_small(state, moves, "label", bound=n_clusters).select(
            F.coalesce("to", "label").alias("label"), "n", "total", F.coalesce("raised", "height").alias("height")
        )
        if linkage == "average":
            sums = moved.select("label", "n", "height", array_to_vector("total").alias("v")).groupBy("label")
            moved = sums.agg(
                F.sum("n").alias("n"), Summarizer.sum(F.col("v")).alias("total"), F.max("height").alias("height")
            ).withColumn("total", vector_to_array("total"))
        state = stored(moved.select("label", "n", "total", "height"))
    return rounds


def _unit_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            units = vectors.unit_rows(vectors.matrix(batch.column(1)))
            ones = pa.array(np.ones(batch.num_rows, np.int64))
            columns = [batch.column(0), ones, vectors.list_column(units, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "n", "total"])


def _nearest_groups(state: DataFrame) -> DataFrame:
    """``(group, pair)`` with the nearest other group of each group, as ``(gap, a, b, height)``.

    The rows of the state pass by blocks of its own rows.  Equal distances go
    by the ids of the pair.
    """
    numbered = state.withColumn("row", F.monotonically_increasing_id())
    result = state.select(
        "label", "n", "total", "height",
        *(F.lit(None).cast(t).alias(c) for c, t in (("gap", "double"), ("other", "int"), ("above", "double"))),
    )
    for rows in row_blocks(numbered, "row"):
        block = (
            np.array([r["label"] for r in rows], np.int32),
            np.array([r["total"] for r in rows], np.float64) / np.array([r["n"] for r in rows])[:, None],
            np.array([r["height"] for r in rows]),
        )
        shared = state.sparkSession.sparkContext.broadcast(block)
        result = result.mapInArrow(_nearest_in_groups(shared), result.schema)
    low, high = F.least("label", "other"), F.greatest("label", "other")
    pair = F.struct("gap", low.alias("a"), high.alias("b"), F.greatest("gap", "height", "above").alias("height"))
    return result.where("gap IS NOT NULL").groupBy(F.col("label").alias("group")).agg(F.min(pair).alias("pair"))


def _nearest_in_groups(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, means, heights = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(0).to_numpy()
            mine = vectors.matrix(batch.column(2)) / batch.column(1).to_numpy()[:, None]
            best = [batch.column(i).to_pylist() for i in (4, 5, 6)]
            for i, (label, mean) in enumerate(zip(own, mine, strict=True)):
                # The same order of sums from both sides, so that both see the same number.
                gap = np.clip(1.0 - np.einsum("ij,j->i", means, mean), 0.0, 2.0).round(12)
                gap[labels == label] = np.inf
                least = gap.min()
                if np.isinf(least):
                    continue
                tied = np.flatnonzero(gap == least)
                at = min(tied, key=lambda j: (min(label, labels[j]), max(label, labels[j])))
                found = (least, min(label, labels[at]), max(label, labels[at]))
                old = best[0][i]
                if old is None or found < (old, min(label, best[1][i]), max(label, best[1][i])):
                    best[0][i], best[1][i], best[2][i] = float(least), int(labels[at]), float(heights[at])
            kinds = (pa.float64(), pa.int32(), pa.float64())
            columns = [*batch.columns[:4], *(pa.array(b, k) for b, k in zip(best, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def _mutual_groups(nearest: DataFrame, threshold: float | None) -> DataFrame:
    """Groups that are nearest to each other, as ``(kept, gone, height)``."""
    mutual = nearest.groupBy("pair.a", "pair.b").agg(
        F.count("*").alias("sides"), F.max("pair.height").alias("height"), F.max("pair.gap").alias("gap")
    ).where("sides = 2")
    if threshold is not None:
        mutual = mutual.where(F.col("gap") < threshold)
    return mutual.select(F.col("a").alias("kept"), F.col("b").alias("gone"), "height")


def _summaries(state: DataFrame) -> DataFrame:
    """Per group the mean of its unit vectors, the radius around it, and a few outer members.

    A group is at most as large as the table of clusters.  Outer members are
    picked one by one, each the farthest from those before; a small group is
    all of its members, ``whole``.
    """

    def run(group: pa.Table) -> pa.Table:
        units = vectors.matrix(group["total"].combine_chunks())
        mean = units.mean(axis=0)
        radius = vectors.exact_distance(units, mean)
        picked = [int(radius.argmax())]
        far = vectors.exact_distance(units, units[picked[0]])
        far[picked] = -1.0
        while len(picked) < min(OUTER_MEMBERS, len(units)):
            picked.append(int(far.argmax()))
            far = np.minimum(far, vectors.exact_distance(units, units[picked[-1]]))
            # A member is not picked twice, not even among equal ones.
            far[picked] = -1.0
        outer = np.resize(units[picked], (OUTER_MEMBERS, units.shape[1]))
        return pa.table(
            {
                "label": group["label"].slice(0, 1),
                "mean": vectors.list_column(mean[None], pa.float64()),
                "radius": [float(radius.max())],
                "outer": vectors.list_column(outer.reshape(1, -1), pa.float64()),
                "whole": [len(units) <= OUTER_MEMBERS],
                "zero": [bool((~units.any(axis=1)).any())],
                "height": [max(group["height"].to_pylist())],
            }
        )

    schema = "label INT, mean ARRAY<DOUBLE>, radius DOUBLE, outer ARRAY<DOUBLE>, whole BOOLEAN, zero BOOLEAN, height DOUBLE"
    return state.groupBy("label").applyInArrow(run, schema)


class _Bounds:
    """Bounds on the greatest distance between members of the groups of two tables."""

    def __init__(self, labels, means, radius, outer, whole, zero) -> None:
        self.labels, self.means, self.radius = labels, means, radius
        self.outer = outer.reshape(len(labels), OUTER_MEMBERS, -1)
        self.whole, self.zero = whole, zero

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> _Bounds:
        columns = {n: batch.column(n) for n in ("label", "radius", "whole", "zero")}
        label, radius, whole, zero = (c.to_numpy(zero_copy_only=False) for c in columns.values())
        return cls(label, vectors.matrix(batch.column("mean")), radius, vectors.matrix(batch.column("outer")), whole, zero)

    def against(self, other: _Bounds) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible value for every two groups, equal where it is known."""
        least = 1.0 - self.means @ other.means.T
        for i in range(OUTER_MEMBERS):
            for j in range(OUTER_MEMBERS):
                np.maximum(least, 1.0 - self.outer[:, i] @ other.outer[:, j].T, out=least)
        sq, slack = vectors.squared_screen(self.means, other.means)
        reach = np.sqrt(np.maximum(sq + slack[:, None], 0.0)) + self.radius[:, None] + other.radius[None, :]
        most = np.minimum(0.5 * reach * reach, 2.0)
        # A zero vector is at distance 1 from everything, whatever the length of the gap.
        most = np.where(self.zero[:, None] | other.zero[None, :], np.maximum(most, 1.0), most)
        known = self.whole[:, None] & other.whole[None, :]
        most = np.where(known, least, most)
        same = self.labels[:, None] == other.labels[None, :]
        return np.where(same, np.inf, np.maximum(least, 0.0) - BOUND_SLACK), np.where(same, np.inf, most + BOUND_SLACK)


def _group_blocks(summaries: DataFrame) -> Iterator:
    """The groups as broadcasts of bounded size."""
    names = ("label", "mean", "radius", "outer", "whole", "zero")
    for block in row_blocks(summaries.select(*names), "label", GROUP_BLOCK):
        yield summaries.sparkSession.sparkContext.broadcast([np.array([r[n] for r in block]) for n in names])


def _against(shared, step):
    """``step(bounds of a slice of rows, the slice, bounds of a block)`` as a function of batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        other = _Bounds(*shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, GROUP_BLOCK):
                part = batch.slice(start, GROUP_BLOCK)
                yield step(_Bounds.of(part), part, other)

    return run


def _lower_limit(mine: _Bounds, batch: pa.RecordBatch, other: _Bounds) -> pa.RecordBatch:
    """The batch with ``limit`` lowered to the least upper bound in a block."""
    _, most = mine.against(other)
    limit = np.minimum(batch.column("limit").to_numpy(), most.min(axis=1, initial=np.inf))
    columns = [pa.array(limit) if n == "limit" else batch.column(n) for n in batch.schema.names]
    return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def _open_pairs(mine: _Bounds, batch: pa.RecordBatch, other: _Bounds) -> pa.RecordBatch:
    """The pairs of groups that can be nearest, from either side."""
    least, _ = mine.against(other)
    row, place = np.nonzero(least <= batch.column("limit").to_numpy()[:, None])
    pair = [np.minimum(mine.labels[row], other.labels[place]), np.maximum(mine.labels[row], other.labels[place])]
    return pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)) for p in (*pair, mine.labels[row])], names=["a", "b", "label"])


def _nearest_by_farthest_pair(state: DataFrame) -> DataFrame:
    """``(group, pair)`` like ``_nearest_groups``, by the greatest distance between members.

    A group's nearest one is no farther than the least of its upper bounds, so
    only groups whose lower bound is within that are measured.
    """
    summaries = stored(_summaries(state))
    blocks = list(_group_blocks(summaries))
    limited = summaries.withColumn("limit", F.lit(float("inf")))
    for shared in blocks:
        limited = limited.mapInArrow(_against(shared, _lower_limit), limited.schema)
    limited, asked = stored(limited), None
    for shared in blocks:
        part = limited.mapInArrow(_against(shared, _open_pairs), "a INT, b INT, label INT")
        asked = part if asked is None else asked.unionByName(part)
    asked = stored(asked)
    pairs = asked.select("a", "b").distinct()
    members = state.select("label", "total", "height")

    def farthest(left: pa.Table, right: pa.Table) -> pa.Table:
        one, two = (vectors.matrix(t["total"].combine_chunks()) for t in (left, right))
        gap = max(
            float(np.clip(1.0 - np.einsum("ij,kj->ik", one[s : s + GROUP_BLOCK], two), 0.0, 2.0).max())
            for s in range(0, len(one), GROUP_BLOCK)
        )
        height = max(*left["height"].to_pylist(), *right["height"].to_pylist())
        return pa.table({"a": left["a"].slice(0, 1), "b": left["b"].slice(0, 1), "gap": [round(gap, 12)], "height": [height]})

    sides = []
    for side in ("a", "b"):
        found = pairs.select("a", "b", F.col(side).alias("label")).join(members, "label")
        sides.append(found.select(*(F.col(c).alias(c) for c in ("a", "b", "total", "height"))).groupBy("a", "b"))
    measured = stored(sides[0].cogroup(sides[1]).applyInArrow(farthest, "a INT, b INT, gap DOUBLE, height DOUBLE"))
    pair = F.struct("gap", "a", "b", F.greatest("gap", "height").alias("height"))
    return asked.join(measured, ["a", "b"]).groupBy(F.col("label").alias("group")).agg(F.min(pair).alias("pair"))


def _split_from_the_top(points: DataFrame, n_parents: int, seed: int) -> DataFrame:
    """``(cluster_id, label)``: clusters split in two by direction until there are ``n_parents`` groups.

    Labels are smallest cluster ids.  Zero centroids have no direction; they go
    with the group of the smallest label.
    """
    rows = points.select("cluster_id", array_to_vector("centroid").alias("features"), F.exists("centroid", lambda v: v != 0).alias("turned"))
    turned = rows.where("turned")
    if n_parents < 2 or turned.isEmpty():
        return points.select("cluster_id", F.lit(points.agg(F.min("cluster_id")).first()[0]).alias("label"))
    model = BisectingKMeans(k=n_parents, seed=seed, distanceMeasure="cosine", predictionCol="leaf").fit(turned)
    leaves = stored(model.transform(turned).select("cluster_id", "leaf"))
    labels = stored(leaves.groupBy("leaf").agg(F.min("cluster_id").alias("label")))
    least = labels.agg(F.min("label")).first()[0]
    found = join_small(leaves, labels, "leaf", bound=n_parents).select("cluster_id", "label")
    # The smallest child of that group may be one without direction.
    rest = rows.where("NOT turned").select("cluster_id")
    first = rest.agg(F.min("cluster_id")).first()[0]
    if first is None:
        return found
    lowest = min(first, least)
    found = found.withColumn("label", F.when(F.col("label") == least, F.lit(lowest)).otherwise(F.col("label")))
    return found.unionByName(rest.withColumn("label", F.lit(lowest)))


def hierarchy_table(groups: DataFrame) -> DataFrame:
    """``(parent_id, child_cluster_ids)``, children ascending."""
    return groups.groupBy("parent_id").agg(
        F.sort_array(F.collect_list("cluster_id")).alias("child_cluster_ids")
    )


def build_hierarchy(
    df: DataFrame, params: HierarchyParams | None = None, vector_col: str = "embedding"
) -> DataFrame:
    """The hierarchy document as one row ``(meta, parents)``.

    Its arrays hold cluster ids only.  ``to_json(struct(meta, parents))`` or
    ``write.json`` gives the JSON form.
    """
    p = params or HierarchyParams()
    groups = group_clusters(centroids(df, p.cluster_col, vector_col), p)
    parents = hierarchy_table(groups).select(
        F.struct(
            "parent_id",
            "child_cluster_ids",
            F.lit("").alias("parent_summary"),
            F.lit("").alias("parent_name"),
        ).alias("parent")
    )
    settings = asdict(p)
    types = {"n_parents": "int", "distance_threshold": "double", "random_state": "int"}
    fields = [F.lit(v).cast(types.get(k, "string")).alias(k) for k, v in settings.items()]
    listed = parents.agg(F.array_sort(F.collect_list("parent")).alias("parents"))
    sizes = F.transform("parents", lambda q: F.size(q["child_cluster_ids"]))
    n_clusters = F.aggregate(sizes, F.lit(0), lambda s, v: s + v)
    doc = listed.select(
        F.struct(
            n_clusters.cast("bigint").alias("n_clusters"),
            F.size("parents").cast("bigint").alias("n_parents"),
            F.struct(*fields).alias("params"),
        ).alias("meta"),
        "parents",
    )
    return doc.to(T.StructType.fromDDL(schemas.HIERARCHY))
