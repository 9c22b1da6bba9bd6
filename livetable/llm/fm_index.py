"""FM-index over a sequence of small numbers, in numpy.

Symbol 0 parts the sequence into runs: it matches nothing and every 0 counts as a
symbol of its own when suffixes are sorted, so equal runs end their comparison there.
Counting goes through a wavelet matrix (one bit vector for each bit of a symbol,
each with running counts); occurrences are located by walking back to the nearest
sampled suffix position.  All queries of a step run together.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16  # every so many positions of a run are sampled, and each run's first


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only suffixes still tied are sorted again."""
    n = len(text)
    zeros = np.flatnonzero(text == 0)
    rank = np.empty(n + 1, np.int32)
    rank[n] = -1
    order = np.argsort(text, kind="stable").astype(np.int32)
    sorted_ = text[order]
    head = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]]).astype(np.int32) if n else np.zeros(0, np.int32)
    rank[order] = np.repeat(head, np.diff(np.append(head, n)))
    rank[zeros] = np.arange(len(zeros))     # each separator is a symbol of its own
    tied = np.flatnonzero(text != 0).astype(np.int32)
    h = 1
    while len(tied):
        major, minor = rank[tied], rank[np.minimum(tied + h, n)] + 1
        key = major.astype(np.int64) * (n + 2) + minor
        o = np.argsort(key, kind="stable")
        tied, key, major = tied[o], key[o], major[o]
        new = np.r_[True, key[1:] != key[:-1]]
        old = np.r_[True, major[1:] != major[:-1]]
        at = np.arange(len(tied), dtype=np.int32)
        group = np.maximum.accumulate(np.where(new, at, 0))
        base = np.maximum.accumulate(np.where(old, at, 0))
        rank[tied] = major + group - base
        last = np.r_[new[1:], True]
        tied = tied[~(new & last)]
        h *= 2
    sa = np.empty(n, np.int32)
    sa[rank[:n]] = np.arange(n, dtype=np.int32)
    return sa


class FMIndex:
    def __init__(self, text: np.ndarray, symbols: int):
        """``text``: 32-bit numbers below ``symbols``, beginning with a 0."""
        text = text.astype(np.int32, copy=False)
        sa = suffix_order(text)
        self.n = len(text)
        self.bwt = text[sa - 1]         # row 0 of the first position takes the last symbol
        self.bwt[sa == 0] = 0
        counts = np.bincount(text, minlength=symbols)
        self.before = np.cumsum(counts) - counts
        self.levels = []                # (bit shift, ones before each row, zeros in all)
        level = self.bwt
        for shift in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            bit = (level >> shift) & 1
            ones = np.zeros(self.n + 1, np.int32)
            np.cumsum(bit, out=ones[1:], dtype=np.int32)
            self.levels.append((shift, ones, self.n - int(ones[-1])))
            level = np.concatenate([level[bit == 0], level[bit == 1]])
        is_start = np.zeros(self.n, bool)
        is_start[1:] = text[:-1] == 0
        places = np.arange(self.n, dtype=np.int32)
        from_start = places - np.maximum.accumulate(np.where(is_start, places, 0))
        sampled = (from_start % SAMPLE == 0) & (text != 0)
        self.has_sample = sampled[sa]
        self.sample_at = np.cumsum(self.has_sample, dtype=np.int32) - 1
        self.samples = sa[self.has_sample]

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in the transform before each row."""
        lo, hi = np.zeros(len(row), np.int64), row
        for shift, ones, zeros in self.levels:
            bit = ((symbol >> shift) & 1).astype(bool)
            a, b = ones[lo], ones[hi]
            lo = np.where(bit, zeros + a, lo - a)
            hi = np.where(bit, zeros + b, hi - b)
        return hi - lo

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of the suffixes that begin with each pattern.
        ``patterns``: (count, width), each pattern at the right end of its row."""
        lo = np.zeros(len(patterns), np.int64)
        hi = np.full(len(patterns), self.n, np.int64)
        width = patterns.shape[1]
        live = np.arange(len(patterns))
        for back in range(width):
            live = live[(lengths[live] > back) & (hi[live] > lo[live])]
            if not len(live):
                break
            c = patterns[live, width - 1 - back]
            both = self.rank(np.concatenate([c, c]), np.concatenate([lo[live], hi[live]]))
            lo[live] = self.before[c] + both[:len(live)]
            hi[live] = self.before[c] + both[len(live):]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of the suffix in each row."""
        out = np.zeros(len(rows), np.int64)
        todo, row, steps = np.arange(len(rows)), rows.copy(), 0
        while len(todo):
            done = self.has_sample[row]
            out[todo[done]] = self.samples[self.sample_at[row[done]]] + steps
            todo, row = todo[~done], row[~done]
            if len(todo):
                c = self.bwt[row]
                row = self.before[c] + self.rank(c, row)
                steps += 1
        return out
