"""Vector expressions, and numpy helpers for Arrow batches inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Screening by matrix product is only trusted up to this relative error; what
# it cannot decide is computed again row by row.
SCREEN_TOLERANCE = 1e-9
# Pairs of vectors that are compared exactly in one go.
PAIR_SLICE = 20_000
# Queries and rows of one matrix product, and rows of which one stands for all in a limit.
SCREEN_QUERIES = 512
SCREEN_ROWS = 2048
SCREEN_RUN = 32


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, v: s + v)


def euclidean(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda s, v: s + v * v))


def cosine_distance(a: Column, b: Column) -> Column:
    """One minus the cosine; 1 when a vector is zero."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms == 0, F.lit(1.0)).otherwise(F.lit(1.0) - dot(a, b) / norms)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls as a float64 matrix, one row per list."""
    if column.null_count:
        raise ValueError("null vector")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = len(column)
    if rows == 0:
        return np.empty((0, 0))
    width = len(flat) // rows
    if not (np.diff(column.offsets.to_numpy()) == width).all():
        raise ValueError("vectors differ in length")
    return flat.reshape(rows, width)


def list_column(values: np.ndarray, dtype: pa.DataType) -> pa.Array:
    """A matrix as a list column."""
    rows, width = values.shape
    offsets = pa.array(np.arange(0, rows * width + 1, max(width, 1), dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel()).cast(dtype))


def unit_rows(values: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay zero."""
    norms = np.sqrt((values * values).sum(axis=1, keepdims=True))
    return np.divide(values, norms, out=np.zeros_like(values), where=norms > 0)


def squared_screen(rows: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of all rows to all points, and their error bound per row."""
    row_sq = (rows * rows).sum(axis=1)
    point_sq = (points * points).sum(axis=1)
    sq = row_sq[:, None] + point_sq[None, :] - 2.0 * (rows @ points.T)
    slack = SCREEN_TOLERANCE * (row_sq + point_sq.max() + 1e-300)
    return sq, slack


def exact_distance(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Distances computed so that equal rows get equal results."""
    gaps = rows - point
    return np.sqrt((gaps * gaps).sum(axis=-1))


def nearest_point(rows: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and distance of the nearest point of each row; ties to the first."""
    sq, slack = squared_screen(rows, points)
    best = sq.argmin(axis=1)
    near = sq <= (sq[np.arange(len(rows)), best] + 2 * slack)[:, None]
    tied = np.flatnonzero(near.sum(axis=1) > 1)
    if len(tied):
        least = np.full(len(tied), np.inf)
        for point in np.flatnonzero(near[tied].any(axis=0)):
            asked = np.flatnonzero(near[tied, point])
            gap = exact_distance(rows[tied[asked]], points[point])
            nearer = gap < least[asked]
            least[asked[nearer]] = gap[nearer]
            best[tied[asked[nearer]]] = point
    return best, exact_distance(rows, points[best])


def nearest_rows(
    queries: np.ndarray, rows: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query its ``k`` nearest rows: query index, row index, distance.

    Equal distances go to the earlier row.
    """
    # Fewer at a time where a query asks for very many.
    step = max(1, min(SCREEN_QUERIES, SCREEN_QUERIES * SCREEN_ROWS // max(k, 1)))
    parts = [_nearest_rows(queries[at : at + step], rows, k) for at in range(0, len(queries), step)]
    if not parts:
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    query = np.concatenate([i * step + part[0] for i, part in enumerate(parts)])
    return query, np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])


def _nearest_rows(queries: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    query_sq, row_sq = (queries * queries).sum(axis=1), (rows * rows).sum(axis=1)
    slack = 2 * SCREEN_TOLERANCE * (query_sq + row_sq.max(initial=0.0) + 1e-300)
    # The k least squared distances seen so far, one per run of rows; the true ones are not above.
    least = np.full((len(queries), k), np.inf)
    asked = np.column_stack([-2.0 * queries, query_sq, np.ones(len(queries))])
    found = []
    for at in range(0, len(rows), SCREEN_ROWS):
        block = rows[at : at + SCREEN_ROWS]
        offered = np.column_stack([block, np.ones(len(block)), row_sq[at : at + SCREEN_ROWS]])
        sq = asked @ offered.T
        runs = len(block) // SCREEN_RUN
        if runs >= 2 * k:
            whole = sq[:, : runs * SCREEN_RUN].reshape(len(queries), SCREEN_RUN, runs).min(axis=1)
            seen = np.concatenate([least, whole, sq[:, runs * SCREEN_RUN :]], axis=1)
        else:
            seen = np.concatenate([least, sq], axis=1)
        least = np.partition(seen, k - 1, axis=1)[:, :k]
        query, row = np.divmod(np.flatnonzero(sq <= (least.max(axis=1) + slack)[:, None]), max(len(block), 1))
        found.append((query, row + at, sq[query, row]))
    if not found:
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    query, row, sq = (np.concatenate(part) for part in zip(*found, strict=True))
    # The limits of early blocks were wider than the last.
    kept = sq <= (least.max(axis=1) + slack)[query]
    query, row = query[kept], row[kept]
    gap = np.empty(len(query))
    for start in range(0, len(query), PAIR_SLICE):
        part = slice(start, start + PAIR_SLICE)
        gap[part] = exact_distance(rows[row[part]], queries[query[part]])
    order = np.lexsort((row, gap, query))
    query, row, gap = query[order], row[order], gap[order]
    # Place within the query: queries are sorted, so count from their first entry.
    place = np.arange(len(query)) - np.searchsorted(query, query)
    kept = place < k
    return query[kept], row[kept], gap[kept]


def first_k(table: pa.Table, k: int, keys: list[tuple[str, str]]) -> pa.Table:
    """The first ``k`` rows under the sort keys, in no particular order."""
    if table.num_rows <= k:
        return table
    return table.take(pc.select_k_unstable(table, k, keys))
