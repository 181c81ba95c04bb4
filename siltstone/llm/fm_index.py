"""A compressed full-text index over a sequence of integers: Burrows-Wheeler transform in a wavelet matrix, and a sample
of the suffix array.

What is kept of n symbols below 2**b is n * b bits of the matrix, a count for each 64 of them, and one suffix of each
``RATE``; neither the sequence nor the whole suffix array is kept. Symbol 0 separates passages; separators sort by their
place, so suffixes of equal passages have a fixed order. Searches take arrays of patterns at once.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling (or tripling); every separator is a smallest symbol of its own, in order of place."""
    n, separators = len(symbols), int((symbols == 0).sum())
    rank = symbols.astype(np.int64) + separators
    rank[symbols == 0] = np.arange(separators)
    step = 1
    while True:
        base = int(rank.max(initial=0)) + 2
        times = 3 if base < 1 << 20 else 2  # so many stretches of ``step`` symbols fit into one key
        key = rank.copy()
        for i in range(1, times):
            key *= base
            if i * step < n:
                key[: n - i * step] += rank[i * step :] + 1
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(sorted_[1:] != sorted_[:-1])]) if n else []
        step *= times
        if step >= n or not n or rank.max() == n - 1:
            return order


def _bits(ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits in 64-bit words, and the number of ones before each word."""
    packed = np.packbits(np.concatenate([ones, np.zeros(-len(ones) % 64 + 64, dtype=bool)]), bitorder="little").view("<u8")
    return packed, np.concatenate([[0], np.cumsum(np.bitwise_count(packed))[:-1]]).astype(np.int32)


def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many ones there are before each position."""
    word = at >> 6
    inside = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
    return before[word] + np.bitwise_count(words[word] & inside)


class WaveletMatrix:
    """Bits of the symbols by level, highest first."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits = bits
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.zeros: list[int] = []
        for level in reversed(range(bits)):
            ones = ((symbols >> level) & 1).astype(bool)
            self.levels.append(_bits(ones))
            self.zeros.append(int((~ones).sum()))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` goes on the way down along each symbol's bits; differences are ranks."""
        for level, (words, before) in enumerate(self.levels):
            ones = _ones(words, before, at)
            at = np.where((symbols >> (self.bits - 1 - level)) & 1, self.zeros[level] + ones, at - ones)
        return at

    def follow(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at positions, and where each position goes along its own symbol's bits."""
        symbols = np.zeros(len(at), dtype=np.int64)
        for level, (words, before) in enumerate(self.levels):
            bit = (words[at >> 6] >> (at & 63).astype(np.uint64)).astype(np.int64) & 1
            ones = _ones(words, before, at)
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
            symbols = symbols * 2 + bit
        return symbols, at


class FMIndex:
    """Index of ``symbols`` (0 .. alphabet - 1)."""

    RATE = 32

    def __init__(self, symbols: np.ndarray):
        self.size = len(symbols)
        order = suffix_array(symbols)
        alphabet = int(symbols.max(initial=0)) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=alphabet))]).astype(np.int64)
        self.tree = WaveletMatrix(symbols[order - 1].astype(np.int32), max(1, int(alphabet - 1).bit_length()))
        every = np.arange(alphabet)
        self.shift = self.first[:-1] - self.tree.descend(every, np.zeros(alphabet, dtype=np.int64))
        # Separators are apart in the order of suffixes, so a step back from one is not by its rank: they are sampled too.
        sampled = (order % self.RATE == 0) | (symbols[order - 1] == 0)
        self.marks = _bits(sampled)
        self.samples = order[sampled].astype(np.int32)

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search by one symbol: the suffixes in [low, high) with the symbol in front."""
        both = self.tree.descend(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        n = len(symbols)
        return both[:n] + self.shift[symbols], both[n:] + self.shift[symbols]

    def matching_statistics(self, symbols: np.ndarray, ends: np.ndarray, limit: int, places: int | np.ndarray = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(length, low, high) for each end: how long the longest stretch of ``symbols`` that ends there (its symbols are
        ends - length .. ends - 1) and that has ``places`` places or more in the index is, up to ``limit``, and its suffixes.

        No stretch holds a separator or a symbol that the index has not. ``places`` may differ from end to end.
        """
        places = np.broadcast_to(places, len(ends))
        lengths = np.zeros(len(ends), dtype=np.int64)
        # Stretches that are alike so far are in one state, an interval of suffixes, and are searched for once.
        state = np.zeros(len(ends), dtype=np.int64)
        lows, highs = np.array([0]), np.array([self.size])
        low_of, high_of = np.zeros(len(ends), dtype=np.int64), np.full(len(ends), self.size, dtype=np.int64)
        which = np.flatnonzero(ends > 0)
        state = state[which]
        for step in range(1, limit + 1):
            symbol = symbols[ends[which] - step]
            known = (symbol > 0) & (symbol < len(self.shift))
            which, symbol = which[known], symbol[known]
            pairs, state = np.unique(state[known] * len(self.shift) + symbol, return_inverse=True)
            before, symbol = pairs // len(self.shift), pairs % len(self.shift)
            lows, highs = self.extend(symbol, lows[before], highs[before])
            enough = (highs - lows)[state] >= places[which]
            which, state = which[enough], state[enough]
            lengths[which], low_of[which], high_of[which] = step, lows[state], highs[state]
            more = ends[which] > step
            which, state = which[more], state[more]
            if not len(which):
                break
        return lengths, low_of, high_of

    def places(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of some rows begin, by steps back to the next one that is sampled."""
        out = np.zeros(len(rows), dtype=np.int64)
        at, which, steps = rows.astype(np.int64), np.arange(len(rows)), 0
        while len(which):
            words, before = self.marks
            here = (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            out[which[here]] = self.samples[_ones(words, before, at[here])] + steps
            which, at, steps = which[~here], at[~here], steps + 1
            symbols, at = self.tree.follow(at)
            at = at + self.shift[symbols]
        return out

    def locate(self, pattern: np.ndarray) -> np.ndarray:
        """Sorted places of one pattern."""
        length, low, high = self.matching_statistics(pattern, np.array([len(pattern)]), len(pattern))
        if length[0] < len(pattern):
            return np.zeros(0, dtype=np.int64)
        return np.sort(self.places(np.arange(low[0], high[0])))
