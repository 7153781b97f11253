"""Periodic runs of words, by block convolution with exact number-theoretic transforms.

At each dyadic scale a text is cut into blocks of ``size`` words.  The squared
differences of a block and every window at distance ``size`` to ``2 * size - 1``
come from one cyclic convolution, and a sum of zero is an exact occurrence.  A
run of period ``q`` at that scale and four periods or more holds two whole
blocks that recur at distance ``q``, so chains of such blocks find every run,
and only their two ends are compared word by word.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.llm.columns import slices, text_bytes, word_bounds

PERIODS = 4
MIN_WORDS = 6
# Primes below 2**31 with a large power of two in p - 1, and a primitive root of each.
PRIMES = ((2013265921, 31), (1811939329, 13), (469762049, 3))
# Longest transform that all of them have.
MAX_TRANSFORM = 1 << 26
# Symbols that are transformed at once, unless one block has more.
CHUNK = 1 << 17
RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


@functools.lru_cache(maxsize=128)
def _roots(prime: int, root: int, length: int) -> np.ndarray:
    """The first half of the powers of a root of unity of order ``length``."""
    base = pow(root, (prime - 1) // length, prime)
    powers, step = np.ones(1, np.uint64), base
    while 2 * len(powers) <= length // 2:
        # step is the base to the power of len(powers).
        powers = np.concatenate([powers, powers * np.uint64(step) % np.uint64(prime)])
        step = step * step % prime
    return powers


def _reduced(x: np.ndarray, prime: np.uint64) -> np.ndarray:
    """Values below twice the prime, brought below it: a difference below zero wraps round."""
    return np.minimum(x, x - prime)


def transform(x: np.ndarray, prime: int, root: int) -> np.ndarray:
    """The transform of each row, its values in bit-reversed order."""
    p, (rows, width) = np.uint64(prime), x.shape
    half = width // 2
    while half:
        pairs = x.reshape(rows, -1, 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        x = np.empty_like(pairs)
        x[:, :, 0] = _reduced(a + b, p)
        x[:, :, 1] = (a + (p - b)) * _roots(prime, root, 2 * half) % p
        half //= 2
    return x.reshape(rows, width)


def inverse(x: np.ndarray, prime: int, root: int) -> np.ndarray:
    """Rows from their transforms in bit-reversed order."""
    p, (rows, width) = np.uint64(prime), x.shape
    back, half = pow(root, -1, prime), 1
    while half < width:
        pairs = x.reshape(rows, -1, 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1] * _roots(prime, back, 2 * half) % p
        x = np.empty_like(pairs)
        x[:, :, 0] = _reduced(a + b, p)
        x[:, :, 1] = _reduced(a + (p - b), p)
        half *= 2
    return x.reshape(rows, width) * np.uint64(pow(width, -1, prime)) % p


def occurrences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each row, where its block occurs in its window, as flags for every offset.

    Symbols are numbers from 1; a window is twice as wide as a block and may be
    padded with zeros, which match nothing.  Sums of squared differences are
    known modulo enough primes to tell every positive sum from zero.
    """
    rows, size = blocks.shape
    most = size * int(max(blocks.max(initial=0), windows.max(initial=0))) ** 2
    found, covered = np.ones((rows, size), bool), 1
    for prime, root in PRIMES:
        p = np.uint64(prime)
        squares = np.zeros((rows, 2 * size), np.uint64)
        np.cumsum((windows * windows % p)[:, : 2 * size - 1], axis=1, out=squares[:, 1:])
        total = (squares[:, size:] - squares[:, :size]) % p + ((blocks * blocks) % p).sum(axis=1, keepdims=True) % p
        padded = np.zeros((rows, 2 * size), np.uint64)
        padded[:, :size] = blocks[:, ::-1]
        product = transform(padded, prime, root) * transform(windows, prime, root) % p
        cross = inverse(product, prime, root)[:, size - 1 : 2 * size - 1]
        found &= (total + 2 * (p - cross)) % p == 0
        covered *= prime
        if covered > most:
            return found
    raise ValueError(f"blocks of {size} symbols are too long for exact sums")


def _symbols(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words numbered from 1 within each text, and the distance to the next equal word of the text."""
    n = len(codes)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    key = text * (int(codes.max(initial=0)) + 1) + codes
    order = np.argsort(key, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = key[order[1:]] != key[order[:-1]]
    number = np.empty(n, np.int64)
    number[order] = np.cumsum(fresh)
    # Texts keep their places in that order, so the first number of a text is the count before it.
    before = np.concatenate([[0], np.cumsum(fresh)])[offsets[:-1]]
    gap = np.full(n, n + 1, np.int64)
    again = np.flatnonzero(~fresh)
    gap[order[again - 1]] = order[again] - order[again - 1]
    return number - before[text], gap


def _places(offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and start of each block of ``size`` words that can recur inside its text."""
    length = np.diff(offsets)
    count = np.where(length >= PERIODS * size, length // size - 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    step = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return text, offsets[text] + step * size


def _recurring(symbols: np.ndarray, offsets: np.ndarray, widest: np.ndarray, size: int):
    """Text, start and distance of each block that recurs at a distance of this scale.

    A block in which some word does not come again within ``2 * size`` words
    cannot, and one without a neighbour that might belongs to no run, so these
    are not transformed.
    """
    text, start = _places(offsets, size)
    hope = widest[start] < 2 * size
    next_too = np.zeros(len(hope), bool)
    next_too[:-1] = hope[:-1] & hope[1:] & (text[:-1] == text[1:])
    hope = next_too.copy()
    hope[1:] |= next_too[:-1]
    text, start = text[hope], start[hope]
    found = [(text[:0], start[:0], start[:0])]
    step = max(1, CHUNK // (2 * size))
    padded = np.concatenate([symbols, np.zeros(3 * size, np.int64)]).astype(np.uint64)
    for i in range(0, len(start), step):
        part, of = start[i : i + step], text[i : i + step]
        blocks = padded[part[:, None] + np.arange(size)]
        at = part[:, None] + np.arange(size, 3 * size)
        windows = np.where(at < offsets[of + 1][:, None], padded[at], np.uint64(0))
        row, shift = np.nonzero(occurrences(blocks, windows))
        found.append((of[row], part[row], shift + size))
    return (np.concatenate(c) for c in zip(*found, strict=True))


def _chains(text: np.ndarray, start: np.ndarray, distance: np.ndarray, size: int):
    """Two or more neighbouring blocks that recur at one distance: text, start, end and distance."""
    order = np.lexsort((start, distance))
    text, start, distance = text[order], start[order], distance[order]
    cut = np.ones(len(order) + 1, bool)
    cut[1:-1] = (distance[1:] != distance[:-1]) | (start[1:] != start[:-1] + size) | (text[1:] != text[:-1])
    first = np.flatnonzero(cut[:-1])
    last = np.flatnonzero(cut[1:])
    long = last > first
    first, last = first[long], last[long]
    return text[first], start[first], start[last] + size, distance[first]


def _inside(start: np.ndarray, end: np.ndarray, distance: np.ndarray, known: list[tuple[int, int, int]]) -> np.ndarray:
    """Chains inside a known run of a period that divides their distance; they are that run again."""
    order = np.argsort(start, kind="stable")
    along, hidden = start[order], np.zeros(len(start), bool)
    for begin, stop, period in known:
        near = order[np.searchsorted(along, begin) : np.searchsorted(along, stop)]
        hidden[near] |= (end[near] + distance[near] <= stop) & (distance[near] % period == 0)
    return hidden


def _reach(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading symbols are equal."""
    apart = np.flatnonzero(a != b)
    return int(apart[0]) if len(apart) else len(a)


def runs(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Text, start in the text, length and period of every run, by text, start and period.

    A run is a stretch of a text with smallest period ``q``, at least
    ``PERIODS`` periods and ``MIN_WORDS`` words long, that cannot be extended.
    """
    found: list[tuple[int, int, int, int]] = []
    symbols, widest = _symbols(codes, offsets)
    longest, size = int(np.diff(offsets).max(initial=0)), 1
    # Every run so far, by its first word, the word after it, and its period.
    known: list[tuple[int, int, int]] = []
    while PERIODS * size <= longest:
        if 2 * size > MAX_TRANSFORM:
            raise ValueError(f"a text of {longest} words is too long")
        if size > 1:
            # The largest gap among the next ``size`` words.
            widest[: -size // 2] = np.maximum(widest[: -size // 2], widest[size // 2 :])
        text, start, end, distance = _chains(*_recurring(symbols, offsets, widest, size), size)
        fresh = np.flatnonzero(~_inside(start, end, distance, known))
        for t, s, e, q in zip(*(c[fresh].tolist() for c in (text, start, end, distance)), strict=True):
            left = max(int(offsets[t]), s - size)
            s -= _reach(symbols[left:s][::-1], symbols[left + q : s + q][::-1])
            right = min(int(offsets[t + 1]), e + q + size)
            e += q + _reach(symbols[e : right - q], symbols[e + q : right])
            if e - s >= max(MIN_WORDS, PERIODS * q):
                found.append((t, s - int(offsets[t]), e - s, q))
                known.append((s, e, q))
        size *= 2
    return np.array(sorted((t, s, q, n) for t, s, n, q in found), np.int64).reshape(-1, 4)[:, [0, 1, 3, 2]]


def word_codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, equal for equal words, and the first word of each row."""
    data, offsets = text_bytes(column)
    starts, ends, rows = word_bounds(data, offsets)
    lengths = ends - starts
    at = np.concatenate([[0], np.cumsum(lengths)])
    inside = np.repeat(starts - at[:-1], lengths) + np.arange(at[-1])
    buffers = [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data[inside])]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers)
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64), rows


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs(doc_id, text, ...)``.

    ``runs`` lists the runs of words ``(start, length, period)`` by start, then
    period.  ``collapsed`` is the text without the words that some run has after
    its first period, joined by single spaces.

    A null text counts as empty: no words and no runs.  Every row is on its own,
    so repeated rows give repeated results, and a null ``doc_id`` stays null.
    Texts are held whole, up to 2**27 words.  Other columns are not read.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches):
        for part in slices(batches, "text"):
            codes, offsets = word_codes(part.column("text"))
            found = runs(codes, offsets)
            text, start, length, period = found.T
            again = np.zeros(len(codes) + 1, np.int64)
            begin = offsets[text] + start
            np.add.at(again, begin + period, 1)
            np.add.at(again, begin + length, -1)
            kept = np.cumsum(again[:-1]) == 0
            data, ends = text_bytes(part.column("text"))
            raw, texts = data.tobytes(), []
            for i in range(len(part)):
                words, mask = raw[ends[i] : ends[i + 1]].split(), kept[offsets[i] : offsets[i + 1]]
                texts.append(b" ".join(words if mask.all() else itertools.compress(words, mask.tolist())))
            fields = [pa.array(c) for c in (start, length, period)]
            entries = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
            bounds = pa.array(np.searchsorted(text, np.arange(len(part) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(np.diff(offsets).astype(np.int64)),
                    pa.ListArray.from_arrays(bounds, entries).cast(kind),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL(f"n_words long, runs {RUN}, collapsed string")])
    return rows.mapInArrow(run, schema)


def with_periodic_tail(doc_id: Column, text: Column) -> Column:
    """The text, for one document in ten with a tail that repeats a stretch of its words.

    Which documents, where the tail begins and how long the stretch is follow
    from a checksum of the id.
    """
    check = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(check / F.lit(10))

    def tailed(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, F.greatest(n, F.lit(1)))
        period = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, period))
        moved = F.transform(words, lambda w, i: F.get(words, place(i).cast("int")))
        return F.array_join(moved, " ")

    # The words are bound once; Catalyst would split the text again for each mention.
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    changed = F.get(F.transform(F.array(words), tailed), F.lit(0))
    return F.when((F.pmod(check, F.lit(10)) == 0) & text.isNotNull(), changed).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """One row per document with its longest run and hashes of all runs and of the collapsed text."""
    ranked = F.transform("runs", lambda r: F.struct((-r["length"]).alias("order"), r["start"].alias("start"), r["period"].alias("period")))
    best = F.array_min(ranked)
    line = lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    found = found.withColumn("best", best)
    length = -F.col("best.order")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.lit(1000) * length / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
