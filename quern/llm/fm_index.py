"""A compressed FM-index over sequences of integers: a wavelet matrix of bit vectors with block ranks, and sampled places."""

from __future__ import annotations

import numpy as np

#: Every so many places of the text are stored; those between are found by steps through the index.
SAMPLE = 4


class Bits:
    """A bit vector in 64-bit words, with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int32)[:-1]]).astype(np.int32)

    def ones(self, i: np.ndarray) -> np.ndarray:
        """How many of the first i bits are ones."""
        at = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at] + np.bitwise_count(self.words[at] & mask)

    def at(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class FMIndex:
    """Backward search for many patterns at once, over a text of symbols >= 1.

    The text itself isn't kept, and of the suffixes' places one in SAMPLE.
    """

    def __init__(self, text: np.ndarray):
        text = np.append(text.astype(np.int64), 0)  # an end, lower than all symbols
        self.size = n = len(text)
        rank, reach = np.unique(text, return_inverse=True)[1], 1
        while rank.max() < n - 1:  # doubles the symbols by which suffixes are ordered until all differ
            ahead = np.zeros(n, np.int64)
            ahead[: max(0, n - reach)] = rank[reach:] + 1
            rank = np.unique(rank * (n + 2) + ahead, return_inverse=True)[1]
            reach *= 2
        order = np.empty(n, np.int64)
        order[rank] = np.arange(n)
        last = text[order - 1]  # the symbol before each suffix; before the first one stands the end
        kept = order % SAMPLE == 0
        self.marked, self.places = Bits(kept), order[kept].astype(np.int32 if n < 1 << 31 else np.int64)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=int(text.max(initial=0)) + 1))]).astype(np.int64)
        self.levels = max(1, int(text.max(initial=0)).bit_length())
        self.bits, self.zeros = [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (last >> level) & 1
            self.bits.append(Bits(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            last = np.concatenate([last[bit == 0], last[bit == 1]])

    def step(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns that are extended to the left by symbols."""
        start = np.zeros_like(low)
        for level, (bits, zeros) in enumerate(zip(self.bits, self.zeros, strict=True)):
            one = ((symbols >> (self.levels - 1 - level)) & 1).astype(bool)
            a, b, s = bits.ones(low), bits.ones(high), bits.ones(start)
            low, high, start = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b), np.where(one, zeros + s, start - s)
        return self.first[symbols] + low - start, self.first[symbols] + high - start

    def back(self, rows: np.ndarray) -> np.ndarray:
        """The suffixes that start one place before those of rows."""
        at, start, symbols = rows, np.zeros_like(rows), np.zeros_like(rows)
        for bits, zeros in zip(self.bits, self.zeros, strict=True):
            one = bits.at(at).astype(bool)
            a, s = bits.ones(at), bits.ones(start)
            symbols = symbols * 2 + one
            at, start = np.where(one, zeros + a, at - a), np.where(one, zeros + s, start - s)
        return self.first[symbols] + at - start

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of the suffixes of rows."""
        out = np.zeros(len(rows), np.int64)
        open_, at, steps = np.arange(len(rows)), np.asarray(rows, np.int64), 0
        while len(open_):
            known = self.marked.at(at).astype(bool)
            out[open_[known]] = self.places[self.marked.ones(at[known])] + steps
            open_, at = open_[~known], at[~known]
            if len(open_):
                at, steps = self.back(at), steps + 1
        return out

    def matching(self, stream: np.ndarray, ends: np.ndarray, most: int, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of a stream of symbols: how far to the left each of its places `ends` matches, `most` symbols at most.

        A match of an end counts while it comes up at least `times` times in the text. The intervals of suffixes are
        those of the ends that reach `most`; for the others they are empty.
        """
        length = np.zeros(len(ends), np.int64)
        low, high = np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64)
        open_, lo, hi = np.arange(len(ends)), np.zeros(len(ends), np.int64), np.full(len(ends), self.size, np.int64)
        for j in range(most):
            lo, hi = self.step(stream[ends[open_] - j], lo, hi)
            more = hi - lo >= times[open_]
            open_, lo, hi = open_[more], lo[more], hi[more]
            length[open_] = j + 1
        low[open_], high[open_] = lo, hi
        return length, low, high

    def earliest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The first place in the text among the suffixes of each of these intervals, none of which is empty; equal or nested intervals are looked at once."""
        if not len(low):
            return low
        lows, first, which = np.unique(low, return_index=True, return_inverse=True)
        sizes = high[first] - lows
        starts = np.cumsum(sizes) - sizes
        rows = np.arange(sizes.sum()) - np.repeat(starts, sizes) + np.repeat(lows, sizes)
        return np.minimum.reduceat(self.locate(rows), starts)[which]
