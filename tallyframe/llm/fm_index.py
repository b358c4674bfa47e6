"""An FM-index over a sequence of integers: wavelet ranks, backward search, sampled suffix positions.

The sequence holds runs of symbols 1 .. sigma - 1, each run ended by a separator 0. Separators differ from each other when
suffixes are compared, so equal runs need no comparison beyond their ends.
"""

from __future__ import annotations

import numpy as np


def suffix_array(s: np.ndarray) -> np.ndarray:
    """By prefix doubling; separators are ordered by place, before all symbols."""
    n = len(s)
    ends = s == 0
    rank = np.where(ends, np.cumsum(ends) - 1, s.astype(np.int64) + int(ends.sum()))
    _, rank = np.unique(rank, return_inverse=True)
    step = 1
    while True:
        key = rank * np.int64(n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        step *= 2
        if step >= n:
            return order


class WaveletMatrix:
    """Rank and access over symbols below 2^levels, one bit vector with its running count for each level."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits, self.ones, self.zeros = [], [], []
        for level in reversed(range(self.levels)):
            bit = (symbols >> level) & 1
            ones = np.concatenate([[0], np.cumsum(bit)]).astype(np.int64)
            self.bits.append(bit.astype(bool))
            self.ones.append(ones)
            self.zeros.append(len(symbols) - int(ones[-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        self.begin = self._down(np.arange(sigma), np.zeros(sigma, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k in range(self.levels):
            ones = self.ones[k][at]
            at = np.where((symbol >> (self.levels - 1 - k)) & 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, before: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before each place."""
        return self._down(symbol, before) - self.begin[symbol]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and its rank there."""
        symbol = np.zeros(len(at), np.int64)
        for k in range(self.levels):
            bit, ones = self.bits[k][at], self.ones[k][at]
            symbol = symbol << 1 | bit
            at = np.where(bit, self.zeros[k] + ones, at - ones)
        return symbol, at - self.begin[symbol]


class FMIndex:
    def __init__(self, s: np.ndarray, sigma: int, sample: int = 16):
        order = suffix_array(s)
        self.tree = WaveletMatrix(s[order - 1].astype(np.int64), sigma)  # the last symbol is a separator, so -1 may wrap
        self.first = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=sigma))])
        # Run starts are sampled too: a walk to the left never meets a separator.
        starts = np.concatenate([[True], s[:-1] == 0])
        kept = starts | (np.arange(len(s)) % sample == 0)
        self.sampled = kept[order]
        self.position = order[self.sampled]
        self.place = np.cumsum(self.sampled) - 1

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For rows of equally long patterns the range of suffixes that begin with each; empty ranges have lo >= hi."""
        m, width = patterns.shape
        lo, hi = np.zeros(m, np.int64), np.zeros(m, np.int64)
        alive = np.arange(m)
        a, b = np.zeros(m, np.int64), np.full(m, self.first[-1])
        for k in reversed(range(width)):
            symbol = patterns[alive, k]
            a = self.first[symbol] + self.tree.rank(symbol, a)
            b = self.first[symbol] + self.tree.rank(symbol, b)
            live = a < b
            alive, a, b = alive[live], a[live], b[live]
        lo[alive], hi[alive] = a, b
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the sequence of suffixes given by their rows."""
        steps = np.zeros(len(rows), np.int64)
        rows = rows.copy()
        going = np.flatnonzero(~self.sampled[rows])
        while len(going):
            symbol, rank = self.tree.access(rows[going])
            rows[going] = self.first[symbol] + rank
            steps[going] += 1
            going = going[~self.sampled[rows[going]]]
        return self.position[self.place[rows]] + steps
