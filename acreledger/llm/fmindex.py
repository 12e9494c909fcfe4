"""FM-index of one shard over integer symbols: wavelet-matrix ranks and sampled suffix positions."""

from __future__ import annotations

import numpy as np

from .suffixes import suffix_array


class FMIndex:
    """Backward search and location for many patterns at a time.

    The Burrows-Wheeler transform of the symbols is kept as a wavelet matrix: one bit row per binary digit
    of a symbol, each with running counts, so that a rank takes one look-up per digit.  Every ``sample``-th
    text position is stored with its row; other positions are reached by stepping back.
    """

    def __init__(self, symbols: np.ndarray, sample: int = 8):
        text = np.append(np.asarray(symbols, dtype=np.int64) + 1, 0)
        self.n = len(text)
        sa = np.append(self.n - 1, suffix_array(symbols))
        bwt = text[sa - 1]
        counts = np.bincount(text)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        self.levels = []
        digits = max(1, int(text.max()).bit_length())
        rest = bwt
        for digit in range(digits - 1, -1, -1):
            bit = (rest >> digit) & 1
            ones = np.concatenate([[0], np.cumsum(bit)])
            self.levels.append((digit, ones, self.n - int(ones[-1])))
            rest = np.concatenate([rest[bit == 0], rest[bit == 1]])
        self.bwt = bwt
        kept = sa % sample == 0
        self.sampled = np.where(kept, sa, -1)

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often ``symbol`` is among the first ``row`` of the transform."""
        first, row = np.zeros_like(row), row.copy()
        for digit, ones, zeros in self.levels:
            bit = ((symbol >> digit) & 1).astype(bool)
            row = np.where(bit, zeros + ones[row], row - ones[row])
            first = np.where(bit, zeros + ones[first], first - ones[first])
        return row - first

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the patterns; ``patterns`` holds symbols, one padded row each."""
        symbols = patterns.astype(np.int64) + 1
        low, high = np.zeros(len(symbols), np.int64), np.full(len(symbols), self.n, np.int64)
        for step in range(int(lengths.max(initial=0))):
            at = np.flatnonzero((lengths > step) & (low < high))
            if not len(at):
                break
            c = symbols[at, lengths[at] - 1 - step]
            known = c < len(self.before) - 1
            high[at[~known]] = low[at[~known]]
            at, c = at[known], c[known]
            low[at], high[at] = self.before[c] + self.rank(c, low[at]), self.before[c] + self.rank(c, high[at])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows."""
        steps, rows = np.zeros(len(rows), np.int64), rows.copy()
        todo = np.flatnonzero(self.sampled[rows] < 0)
        while len(todo):
            c = self.bwt[rows[todo]]
            rows[todo] = self.before[c] + self.rank(c, rows[todo])
            steps[todo] += 1
            todo = todo[self.sampled[rows[todo]] < 0]
        return self.sampled[rows] + steps
