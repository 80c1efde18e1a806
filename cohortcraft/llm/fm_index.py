"""FM-index over a sequence of word codes: wavelet ranks, backward search, locate.

All steps work on arrays of patterns or rows at once (numpy). Codes 1..sigma
are words; code 0 separates runs and never matches, so no pattern spans two
runs.
"""

from __future__ import annotations

import numpy as np


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; every separator (0) is a smallest symbol of its own.

    Common prefixes end at a separator, so the rounds are bounded by the log of
    the longest run.
    """
    n = len(codes)
    is_sep = codes == 0
    n_sep = int(is_sep.sum())
    rank = codes.astype(np.int64) + n_sep
    rank[is_sep] = np.arange(n_sep)
    order = np.argsort(rank, kind="stable")
    width = 1
    while True:
        ranked = rank[order]
        new = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])]) if n else ranked
        rank[order] = new
        if n == 0 or new[-1] == n - 1:
            return order
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:] + 1
        rank = rank * (n + 1) + after
        order = np.argsort(rank, kind="stable")
        width *= 2


class WaveletRanks:
    """Wavelet tree in matrix form: one bit row with running counts per bit of the symbol."""

    def __init__(self, symbols: np.ndarray, sigma: int) -> None:
        self.bits = max(1, int(sigma).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        row = symbols
        for level in range(self.bits - 1, -1, -1):
            bit = (row >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(len(row) - int(bit.sum()))
            row = np.concatenate([row[bit == 0], row[bit == 1]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each ``symbol`` before position ``i``."""
        start = np.zeros_like(i)
        for level, ones, zeros in zip(range(self.bits - 1, -1, -1), self.ones, self.zeros, strict=True):
            up = ((symbol >> level) & 1).astype(bool)
            before_i, before_start = ones[i], ones[start]
            i = np.where(up, zeros + before_i, i - before_i)
            start = np.where(up, zeros + before_start, start - before_start)
        return i - start

    def access(self, i: np.ndarray) -> np.ndarray:
        """Symbol at each position."""
        symbol = np.zeros_like(i)
        for level, ones, zeros in zip(range(self.bits - 1, -1, -1), self.ones, self.zeros, strict=True):
            before = ones[i]
            up = (ones[i + 1] - before).astype(bool)
            symbol |= up.astype(symbol.dtype) << level
            i = np.where(up, zeros + before, i - before)
        return symbol


class FMIndex:
    """Index of ``codes``; every ``rate``-th position and every run start is sampled for locate."""

    def __init__(self, codes: np.ndarray, sigma: int, rate: int = 8) -> None:
        n = len(codes)
        order = suffix_array(codes)
        before = np.where(order > 0, codes[order - 1], 0) if n else codes
        self.before = WaveletRanks(before.astype(np.int64), sigma)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=sigma + 1))]).astype(np.int64)
        run_start = np.ones(n, bool)
        run_start[1:] = codes[:-1] == 0
        sampled = (order % rate == 0) | run_start[order] if n else np.zeros(0, bool)
        self.sampled = sampled
        self.sample_rank = np.concatenate([[0], np.cumsum(sampled)])
        self.samples = order[sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row range [low, high) of each pattern (rows of equal length, codes >= 1)."""
        last = patterns[:, -1]
        low, high = self.smaller[last], self.smaller[last + 1]
        for j in range(patterns.shape[1] - 2, -1, -1):
            live = np.flatnonzero(low < high)
            if len(live) == 0:
                break
            symbol = patterns[live, j]
            base = self.smaller[symbol]
            low[live], high[live] = base + self.before.rank(symbol, low[live]), base + self.before.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: walk back to a sampled row."""
        out = np.empty(len(rows), np.int64)
        at, row, steps = np.arange(len(rows)), rows.copy(), 0
        while len(at):
            done = self.sampled[row]
            out[at[done]] = self.samples[self.sample_rank[row[done]]] + steps
            at, row = at[~done], row[~done]
            if len(at):
                symbol = self.before.access(row)
                row = self.smaller[symbol] + self.before.rank(symbol, row)
            steps += 1
        return out
