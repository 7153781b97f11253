"""An FM-index over words, for one shard of passages."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Packed bits with the number of ones before each word of 64."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])
        self.zeros = len(bits) - int(bits.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """The number of ones before each position."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletTree:
    """Rank of symbols in a sequence, by one bit vector per bit of the symbols, highest first."""

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self.levels = []
        for place in range(bits - 1, -1, -1):
            bit = (values >> place) & 1
            self.levels.append((place, BitVector(bit.astype(np.uint8))))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the prefix of length ``at`` ends among equal symbols on the lowest level."""
        for place, bits in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> place) & 1, bits.zeros + ones, at - ones)
        return at


class FMIndex:
    """Counts of word windows over weighted passages, by backward search.

    Suffixes are sorted by at least ``window`` words.  The text itself is not
    kept, only the wavelet tree over its Burrows-Wheeler transform, cumulative
    weights, and the groups of suffixes that share ``window - 1`` words.
    """

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, weights: np.ndarray, window: int) -> None:
        """``symbols``: of all passages, concatenated, from 1 up."""
        self.window, count = window, len(lengths)
        n = len(symbols) + count
        text = np.zeros(n, np.int64)  # each passage ends with a zero
        ends = np.cumsum(lengths + 1) - 1
        inside = np.ones(n, bool)
        inside[ends] = False
        text[inside] = symbols
        passage = np.repeat(np.arange(count), lengths + 1)
        order, shared = self._sorted(text, window)
        bits = max(1, int(text.max()).bit_length())
        self.tree = WaveletTree(text[order - 1], bits)
        alphabet = np.arange(int(text.max()) + 1)
        first = np.zeros(len(alphabet) + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=len(alphabet)), out=first[1:])
        self.shift = first[:-1] - self.tree.descend(alphabet, np.zeros(len(alphabet), np.int64))
        self.weights = np.zeros(n + 1, np.int64)
        np.cumsum(weights[passage[order]], out=self.weights[1:])
        starts = np.flatnonzero(~shared)
        group = np.cumsum(~shared) - 1
        self.low, self.high = starts[group], np.append(starts[1:], n)[group]
        self.n = n

    @staticmethod
    def _sorted(text: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """The suffix order by ``window`` words or more, and which share ``window - 1`` words with the one before."""
        n, bits = len(text), max(1, int(text.max()).bit_length())
        depth = max(1, 62 // bits)
        key = np.zeros(n, np.int64)
        for i in range(depth):
            key <<= bits
            key[: n - i] |= text[i:]
        ranks = {}
        while True:
            order = np.argsort(key)
            along = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], along[1:] != along[:-1]])) + 1
            ranks[depth] = rank
            if depth >= window:
                break
            key = rank * (n + 2)
            key[: n - depth] += rank[depth:]
            depth *= 2
        # Equal in the first window - 1 words: two overlapping pieces of known rank.
        shared = np.zeros(n, bool)
        size = max((d for d in ranks if d <= window - 1), default=0)
        if not size:
            size, piece = 1, text
        else:
            piece = ranks[size]
        shared[1:] = True
        for at in [*range(0, max(window - 1 - size, 0), size), max(window - 1 - size, 0)]:
            moved = np.zeros(n, np.int64)
            moved[: n - at] = piece[at:]
            shared[1:] &= moved[order[1:]] == moved[order[:-1]]
        return order, shared

    def recurring(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For each position of the streamed passages, whether the window starting there weighs 2 or more.

        All passages step through their words from the right together.  The
        match is extended by a word, and shortened to ``window - 1`` words once
        it is longer: matching statistics cut off at the threshold.  Words have
        to be known, and windows occur at least once, in the passage itself.
        """
        flags = np.zeros(len(symbols), bool)
        at = np.cumsum(lengths) - 1
        stop = at - lengths
        low, high = np.zeros(len(at), np.int64), np.full(len(at), self.n, np.int64)
        depth = 0
        while len(at):
            symbol = symbols[at]
            low = self.tree.descend(symbol, low) + self.shift[symbol]
            high = self.tree.descend(symbol, high) + self.shift[symbol]
            depth += 1
            if depth >= self.window:
                flags[at] = self.weights[high] - self.weights[low] >= 2
            if depth >= self.window - 1:
                low, high = self.low[low], self.high[low]
            at = at - 1
            live = at > stop
            at, stop, low, high = at[live], stop[live], low[live], high[live]
        return flags
