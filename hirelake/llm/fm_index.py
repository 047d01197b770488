"""A word-level FM-index over one shard: suffix order, wavelet matrix of the BWT, backward search, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order, by prefix doubling. Symbol 0 ends a run; no two ends are equal, so
    comparisons never go beyond a run and the number of rounds is the logarithm of the longest repeat inside runs."""
    n = len(symbols)
    ends = symbols == 0
    rank = symbols.astype(np.int64) + int(ends.sum())
    rank[ends] = np.arange(int(ends.sum()))
    width = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:] + 1 if width < n else 0
        key = rank * (n + len(symbols) + int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.concatenate(([0], (ordered[1:] != ordered[:-1]).astype(np.int64))))
        rank = new
        if rank[order[-1]] == n - 1:
            return order
        width *= 2


class WaveletMatrix:
    """Rank and access over a sequence of symbols below ``2 ** levels``: one packed bit row per level."""

    def __init__(self, sequence: np.ndarray, levels: int):
        self.levels, self.rows, self.counts, self.zeros = levels, [], [], []
        now = sequence
        for level in range(levels - 1, -1, -1):
            bits = ((now >> level) & 1).astype(np.uint8)
            packed = np.packbits(bits, bitorder="little")
            words = np.zeros((len(bits) >> 6) + 1, "<u8")
            words.view(np.uint8)[: len(packed)] = packed
            ones = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))
            self.rows.append(words)
            self.counts.append(ones)
            self.zeros.append(len(bits) - int(bits.sum()))
            now = np.concatenate((now[bits == 0], now[bits == 1]))

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = self.rows[level][word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.counts[level][word] + np.bitwise_count(below)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before position ``at``, element by element."""
        first = np.zeros_like(at)
        for k in range(self.levels):
            one = ((symbol >> (self.levels - 1 - k)) & 1).astype(bool)
            a, b = self._ones(k, first), self._ones(k, at)
            first = np.where(one, self.zeros[k] + a, first - a)
            at = np.where(one, self.zeros[k] + b, at - b)
        return at - first

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for k in range(self.levels):
            one = ((self.rows[k][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
            ones = self._ones(k, at)
            symbol = symbol * 2 + one
            at = np.where(one, self.zeros[k] + ones, at - ones)
        return symbol


class FMIndex:
    """Counts and locates phrases in a text of symbols 1, 2, ... with 0 after each run."""

    def __init__(self, symbols: np.ndarray, largest: int, every: int = 8):
        order = suffix_order(symbols)
        bwt = symbols[order - 1].astype(np.int64)  # before the first symbol stands the last, an end
        self.size = len(symbols)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=largest + 1))))
        self.wavelet = WaveletMatrix(bwt, max(1, int(largest).bit_length()))
        kept = (order % every == 0) | (bwt == 0)  # a walk never crosses the start of a run
        self.kept_rows = np.flatnonzero(kept)
        self.kept_positions = order[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of phrases of one length (a matrix of symbols), by backward search over all of them at once."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        alive = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, column]
            low[alive] = self.before[symbol] + self.wavelet.rank(symbol, low[alive])
            high[alive] = self.before[symbol] + self.wavelet.rank(symbol, high[alive])
            high[alive] = np.maximum(low[alive], high[alive])
            alive = alive[low[alive] < high[alive]]
        return low, high

    def positions(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: steps back to the next kept row."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        out = np.empty(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            now = rows[open_]
            slot = np.minimum(np.searchsorted(self.kept_rows, now), len(self.kept_rows) - 1)
            found = self.kept_rows[slot] == now
            out[open_[found]] = self.kept_positions[slot[found]] + steps[open_[found]]
            open_, now = open_[~found], now[~found]
            symbol = self.wavelet.access(now)
            rows[open_] = self.before[symbol] + self.wavelet.rank(symbol, now)
            steps[open_] += 1
        return out
