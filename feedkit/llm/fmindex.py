"""An FM-index over word symbols: suffix array, wavelet matrix ranks, sampled positions.

The text is a row of runs of symbols 1..n, each run followed by a separator.  Separators sort
before all symbols and by place, so no comparison of two suffixes reaches beyond its run.
"""

from __future__ import annotations

import numpy as np


def suffix_order(ranks: np.ndarray) -> np.ndarray:
    """Places of all suffixes in order, by prefix doubling."""
    n, width = len(ranks), 1
    rank = np.unique(ranks, return_inverse=True)[1].astype(np.int64)
    while True:
        after = np.zeros(n, np.int64)
        after[: max(n - width, 0)] = rank[width:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.zeros(n, np.int64)
        new[1:] = np.cumsum(ordered[1:] != ordered[:-1])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if n == 0 or new[-1] == n - 1:
            return order
        width *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit of the symbols per level."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.zeros, self.levels = bits, [], []
        now = symbols
        for level in range(bits - 1, -1, -1):
            bit = (now >> level) & 1
            before = np.zeros(len(now) + 1, np.int64)
            np.cumsum(bit == 0, out=before[1:])
            self.levels.append(before)
            self.zeros.append(int(before[-1]))
            now = np.concatenate([now[bit == 0], now[bit == 1]])

    def rank(self, symbol: np.ndarray, *places: np.ndarray) -> list[np.ndarray]:
        """How often ``symbol`` stands before each place."""
        all_places = [np.zeros_like(symbol), *places]
        for k, before in enumerate(self.levels):
            one = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            all_places = [np.where(one, self.zeros[k] + p - before[p], before[p]) for p in all_places]
        return [p - all_places[0] for p in all_places[1:]]

    def at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it stands before the place."""
        value, start, now = np.zeros_like(places), np.zeros_like(places), places
        for k, before in enumerate(self.levels):
            one = before[now + 1] == before[now]
            value = value * 2 + one
            now = np.where(one, self.zeros[k] + now - before[now], before[now])
            start = np.where(one, self.zeros[k] + start - before[start], before[start])
        return value, now - start


class FMIndex:
    """``runs``: symbols from 1 on; ``starts``: where each run begins.  ``sample``: distance of kept positions."""

    def __init__(self, runs: np.ndarray, starts: np.ndarray, top: int, sample: int = 8):
        lengths = np.diff(np.append(starts, len(runs)))
        self.sample, n_runs = sample, len(starts)
        place = np.arange(len(runs)) + np.repeat(np.arange(n_runs), lengths)
        n = len(runs) + n_runs
        text = np.zeros(n, np.int64)
        text[place] = runs
        stops = np.flatnonzero(text == 0)
        ranks = text + n_runs
        ranks[stops] = np.arange(n_runs)
        order = suffix_order(ranks)
        self.last = WaveletMatrix(text[order - 1], max(1, int(top).bit_length()))
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        # a walk back from inside a run must end in it: its first place is always kept
        into = np.zeros(n, np.int64)
        into[place] = np.arange(len(runs)) - np.repeat(starts, lengths)
        source = np.full(n, -1)
        source[place] = np.arange(len(runs))
        kept = (into % sample == 0) & (source >= 0)
        self.kept = kept[order]
        self.rank_kept = np.concatenate([[0], np.cumsum(self.kept)])
        self.places = source[order[self.kept]]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each phrase (right-aligned in its row)."""
        width = phrases.shape[1]
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.before[-1])
        live = np.arange(len(phrases))
        for step in range(width):
            on = lengths[live] > step
            live = live[on & (low[live] < high[live])]
            if not len(live):
                break
            symbol = phrases[live, width - 1 - step]
            first = self.before[symbol]
            a, b = self.last.rank(symbol, low[live], high[live])
            low[live], high[live] = first + a, first + b
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in ``runs`` of the suffixes in the given rows."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        open_ = np.flatnonzero(~self.kept[rows])
        while len(open_):
            symbol, count = self.last.at(rows[open_])
            rows[open_] = self.before[symbol] + count
            steps[open_] += 1
            open_ = open_[~self.kept[rows[open_]]]
        return self.places[self.rank_kept[rows]] + steps
