"""Text columns of Arrow batches as byte arrays, in slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A slice has at least one row, and more only up to this many bytes of text.
SLICE_BYTES = 1 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
# An odd multiplier and its inverse modulo 2**64.
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def mix(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit hash of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX[0]
    x ^= x >> np.uint64(33)
    x *= _MIX[1]
    x ^= x >> np.uint64(33)
    return x


def byte_codes() -> np.ndarray:
    """A fixed random-looking 64-bit value for each byte."""
    return mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _STEP)


class Powers:
    """Powers of the multiplier and of its inverse, as many as were asked for so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            steps = np.full((2, size), np.uint64(_BASE))
            steps[1] = np.uint64(_INVERSE)
            steps[:, 0] = 1
            self.up, self.down = np.multiply.accumulate(steps, axis=1)
        return self.up[:n], self.down[:n]


def prefix_sums(values: np.ndarray, powers: Powers) -> np.ndarray:
    """Sums S for which (S[e] - S[s]) * down[s] depends on values[s:e] only."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0], out=sums[1:])
    return sums


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array, nulls as empty, and the offsets of its rows."""
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches, name: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches again, in pieces of bounded bytes in column ``name``."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < len(batch):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each row the number of words before it.

    A word is a maximal run of bytes other than ASCII white space in one row.
    """
    space = np.ones(len(data) + 1, bool)
    lut = np.zeros(256, bool)
    lut[list(SPACES)] = True
    space[:-1] = lut[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data) + 1, bool)
    before[0], before[1:] = True, space[:-1]
    starts = np.flatnonzero(~space & (before | edge))
    ends = np.flatnonzero(~before & (space | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    sums = prefix_sums(byte_codes()[data], powers)
    down = powers(len(data) + 1)[1]
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
