"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.llm.components import star_components
from talkatlas.runtime import stored

MIN_COSINE = 0.98
TABLES = 4
# Hashes joined in one key, and keys that a vector enters per table: its own and the next likely ones.
HASHES = 3
PROBES = 3
ROTATIONS = 3
SEED = 11
# A larger bucket is cut into blocks, and each pair of blocks is compared on its own.
BLOCK_ROWS = 2000
# Rows that are held at once, unless one pair of blocks has more; and those of one matrix product.
HELD_ROWS = 8000
PRODUCT_ROWS = 256
# Rows of a group up to which neighbours are compared step by step, all groups together.
STEP_ROWS = 48


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row; the width is a power of two."""
    count, width = x.shape
    x, step = x.copy(), 1
    while step < width:
        pairs = x.reshape(count, -1, 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(count, width)
        step *= 2
    return x


def signs(width: int, tables: int, hashes: int, rotations: int, seed: int) -> np.ndarray:
    """Random signs, the same in every task."""
    shape = (tables, hashes, rotations, width)
    return np.random.default_rng([seed, width]).integers(0, 2, shape) * 2.0 - 1.0


def bucket_keys(x: np.ndarray, tables: int, hashes: int, probes: int, rotations: int, seed: int) -> np.ndarray:
    """Keys of unit vectors: rows by tables by probes, the most likely key first.

    A hash is the axis, with its sign, that is nearest to the rotated vector.
    Further keys replace one hash by the second nearest axis, cheapest first.
    """
    width = 1 << max(1, (x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), width))
    padded[:, : x.shape[1]] = x
    flips = signs(width, tables, hashes, rotations, seed)
    keys = np.zeros((len(x), tables, probes), np.int64)
    for table in range(tables):
        near, gap, first = [], [], []
        for which in range(hashes):
            y = padded
            for flip in flips[table, which]:
                y = hadamard(y * flip) / np.sqrt(width)
            size = np.abs(y)
            top = np.argpartition(-size, 1, axis=1)[:, :2]
            rows = np.arange(len(x))[:, None]
            top = np.take_along_axis(top, np.argsort(-size[rows, top], axis=1, kind="stable"), axis=1)
            best = size[rows, top]
            code = 2 * top + (y[rows, top] < 0)
            first.append(code[:, 0])
            near.append(code[:, 1])
            gap.append(best[:, 0] - best[:, 1])
        codes = np.stack(first, axis=1)
        order = np.argsort(np.stack(gap, axis=1), axis=1, kind="stable")
        for probe in range(probes):
            chosen = codes.copy()
            if probe:
                at = order[:, probe - 1]
                chosen[np.arange(len(x)), at] = np.stack(near, axis=1)[np.arange(len(x)), at]
            key = np.zeros(len(x), np.int64)
            for which in range(hashes):
                key = key * (2 * width) + chosen[:, which]
            keys[:, table, probe] = key
    return keys


def _hashed(points: DataFrame, tables: int, hashes: int, probes: int, rotations: int, seed: int) -> DataFrame:
    """``node, copies, label, size, embedding, keys``; ``size`` is the dimension."""

    def run(batches):
        for batch in batches:
            sizes = batch.column("embedding").value_lengths().to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                keys = bucket_keys(_units(part.column("embedding"), size), tables, hashes, probes, rotations, seed)
                width = tables * probes
                tagged = keys + (np.arange(tables) << 48)[None, :, None]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * width, pa.int32()), pa.array(tagged.ravel()))
                columns = [part.column(c) for c in ("node", "copies", "label", "embedding")]
                sizes_of = pa.array(np.full(len(part), size, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*columns, sizes_of, lists], ["node", "copies", "label", "embedding", "size", "keys"]
                )

    rows = points.select("node", "copies", "label", "embedding")
    fields = T.StructType.fromDDL("size int, keys array<long>").fields
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *fields]))


def _units(lists: pa.Array, size: int) -> np.ndarray:
    """Vectors of one dimension as rows of length one, in double precision."""
    dense = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    dense = dense / np.abs(dense).max(axis=1, keepdims=True)
    return dense / np.linalg.norm(dense, axis=1, keepdims=True)


def _united(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union the groups of the row pairs (a, b) in ``root``."""
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(root, again := root[root]):
            root[:] = again
        rest = root[a] != root[b]
        a, b = a[rest], b[rest]


def _pairs(group: np.ndarray, side: np.ndarray, unit: np.ndarray, min_cosine: float):
    """Row pairs of equal ``group`` with a cosine of ``min_cosine`` or more, in pieces.

    Sides 1 and 2 are compared with each other only, rows of side 0 with all.
    """
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(starts, len(group)))
    small = np.repeat(sizes <= STEP_ROWS, sizes)
    rows, step = np.flatnonzero(small[:-1]), 1
    while len(rows):
        rows = rows[rows + step < len(group)]
        rows = rows[group[rows + step] == group[rows]]
        for s in range(0, len(rows), HELD_ROWS):
            a = rows[s : s + HELD_ROWS]
            b = a + step
            near = (np.einsum("ij,ij->i", unit[a], unit[b]) >= min_cosine) & ((side[a] == 0) | (side[a] != side[b]))
            yield a[near], b[near]
        step += 1
    for start, size in zip(starts[sizes > STEP_ROWS], sizes[sizes > STEP_ROWS], strict=True):
        inside = np.arange(start, start + size)
        left, right = inside[side[inside] < 2], inside[side[inside] != 1]
        for s in range(0, len(left), PRODUCT_ROWS):
            rows = left[s : s + PRODUCT_ROWS]
            a, b = np.nonzero(unit[rows] @ unit[right].T >= min_cosine - 1e-9)
            a, b = rows[a], right[b]
            near = ((side[a] != 0) | (a < b)) & (np.einsum("ij,ij->i", unit[a], unit[b]) >= min_cosine)
            yield a[near], b[near]


def _compare(table: pa.Table, tables: int, probes: int, min_cosine: float) -> pa.RecordBatch:
    """Links and a tree of links of sorted rows of one dimension.

    A pair is counted only in the first of the buckets in which it meets.
    """
    size = table.column("size")[0].as_py()
    unit = _units(table.column("embedding").combine_chunks(), size)
    keys = table.column("keys").combine_chunks().flatten().to_numpy().reshape(-1, tables, probes)
    bucket = table.column("bucket").to_numpy()
    node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
    group, side = table.column("group").to_numpy(), table.column("side").to_numpy()
    links, root = np.zeros(len(node), np.int64), np.arange(len(node))
    for a, b in _pairs(group, side, unit, min_cosine):
        _united(root, a, b)
        for s in range(0, len(a), HELD_ROWS):
            x, y = a[s : s + HELD_ROWS], b[s : s + HELD_ROWS]
            # Keys carry their table in the high bits, so the least common key is the first bucket.
            equal = keys[x][:, :, :, None] == keys[y][:, :, None, :]
            common = np.where(equal, keys[x][:, :, :, None], np.iinfo(np.int64).max).min(axis=(1, 2, 3))
            fresh = common == bucket[x]
            np.add.at(links, x[fresh], copies[y[fresh]])
            np.add.at(links, y[fresh], copies[x[fresh]])
    some = np.flatnonzero((links > 0) | (root != np.arange(len(node))))
    columns = [pa.array(v) for v in (node[some], links[some], node[root[some]])]
    return pa.RecordBatch.from_arrays(columns, ["node", "links", "root"])


def _compared(tables: int, probes: int, min_cosine: float):
    """Rows sorted by ``size, group`` to ``node, links, root``, a bounded number of groups at a time."""

    def run(batches):
        held, count = [], 0
        for batch in batches:
            while len(batch):
                group, size = batch.column("group").to_numpy(), batch.column("size").to_numpy()
                ends = np.flatnonzero((group[1:] != group[:-1]) | (size[1:] != size[:-1])) + 1
                if held:
                    last = held[-1]
                    if last.column("size")[-1].as_py() != size[0]:
                        yield _compare(pa.Table.from_batches(held), tables, probes, min_cosine)
                        held, count = [], 0
                    elif count >= HELD_ROWS and last.column("group")[-1].as_py() != group[0]:
                        yield _compare(pa.Table.from_batches(held), tables, probes, min_cosine)
                        held, count = [], 0
                # Up to the end of a dimension, or of a group once there are enough rows.
                other = np.flatnonzero(size != size[0])
                stop = int(other[0]) if len(other) else len(batch)
                enough = ends[ends + count >= HELD_ROWS]
                stop = min(stop, int(enough[0])) if len(enough) else stop
                held.append(batch.slice(0, stop))
                count += stop
                batch = batch.slice(stop)
        if held:
            yield _compare(pa.Table.from_batches(held), tables, probes, min_cosine)

    return run


def _memberships(hashed: DataFrame) -> DataFrame:
    """``node, bucket, group, side`` of every bucket that holds two vectors or more.

    A bucket of several blocks appears once per pair of blocks, and a vector in
    all pairs with its block.  ``group`` is a hash that keeps pairs apart.
    """
    entries = hashed.select("node", "label", "size", F.explode("keys").alias("bucket"))
    same = ["label", "size", "bucket"]
    blocks = F.ceil(F.col("n") / F.lit(BLOCK_ROWS)).cast("int")
    full = stored(entries.groupBy(*same).agg(F.count("*").alias("n")).where("n > 1").select(*same, blocks.alias("blocks")))
    rows = entries.join(full, same)
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(low == high, 0).when(F.col("own") == low, 1).otherwise(2).cast("int")
    group = F.xxhash64(*same, low, high)
    return rows.select("node", "bucket", group.alias("group"), side.alias("side"))


def near_duplicates(
    rows: DataFrame,
    min_cosine: float = MIN_COSINE,
    tables: int = TABLES,
    hashes: int = HASHES,
    probes: int = PROBES,
    rotations: int = ROTATIONS,
    seed: int = SEED,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``rows(vec_id, embedding, label, ...)``.

    Rows of equal label and dimension link at a cosine of ``min_cosine`` or
    more, in double precision.  Pairs come from buckets of cross-polytope
    hashes, with ``probes`` keys per table, and are verified.  Identical
    vectors are hashed once.  ``n_links`` counts linked rows, copies included;
    ``component_id`` is the smallest ``vec_id`` reachable.

    A null label, a null, empty or zero vector, and one that holds null or
    non-finite components link with nothing.  Repeated rows link like others.
    A null ``vec_id`` names a component only if no other id is there, and is
    not kept.  Other columns are not read.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = F.col("label").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda v: v != 0)
    usable = F.coalesce(usable, F.lit(False))
    rows = rows.select("vec_id", "label", "embedding")
    same = ["label", "embedding"]
    points = rows.where(usable).groupBy(*same).agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    # Numbered in a table, so that a task that runs again reads the same numbers.
    points = stored(stored(points).withColumn("node", F.monotonically_increasing_id()))
    hashed = stored(_hashed(points, tables, hashes, probes, rotations, seed))
    members = stored(_memberships(hashed))
    paired = members.join(hashed.drop("label"), "node").repartition("group").sortWithinPartitions("size", "group")
    found = stored(paired.mapInArrow(_compared(tables, probes, min_cosine), "node long, links long, root long"))
    roots = star_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = points.drop("embedding", "label").join(links, "node", "left").join(roots, "node", "left")
    named = stored(named.withColumn("root", F.coalesce("root", "node")))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(least, "root").select("node", "links", "copies", "component_id")
    named = stored(points.select("node", *same).join(named, "node").drop("node"))
    counted = rows.where(usable).join(named, same).select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"), "component_id"
    )
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    return counted.unionByName(alone).select("*", kept)
