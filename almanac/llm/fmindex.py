"""An FM-index over a sequence of small integers: suffix order, wavelet-tree ranks, sampled positions.

All steps are vectorised: many patterns are searched and many occurrences located at once.
"""

from __future__ import annotations

import numpy as np


def suffix_order(seq: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in sorted order; the last symbol must be unique and the least.

    Several symbols are packed into one key for the first sort; then the sorted depth doubles,
    and only suffixes that still tie are sorted again.
    """
    n = len(seq)
    bits = max(1, int(seq.max()).bit_length())
    depth = min(max(1, 62 // bits), n)
    key = np.zeros(n, np.int64)
    for j in range(depth):
        key <<= bits
        key[: n - j] |= seq[j:]
    order = np.argsort(key)
    k = key[order]
    new = np.concatenate(([True], k[1:] != k[:-1]))
    rank = np.empty(n, np.int64)  # of a suffix: the place of the first one that ties with it
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    while True:
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            return order
        s = order[at]
        after = np.where(s + depth < n, rank[np.minimum(s + depth, n - 1)], -1)
        group = rank[s]
        by = np.lexsort((after, group))
        s, after, group = s[by], after[by], group[by]
        order[at] = s
        fresh = np.concatenate(([True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])))
        new[at] = fresh
        rank[s] = np.maximum.accumulate(np.where(fresh, at, 0))
        depth *= 2


class FMIndex:
    """Backward search and location over ``seq`` (positive integers; a terminator 0 is added)."""

    def __init__(self, seq: np.ndarray, sample: int = 16):
        text = np.concatenate((seq, [0])).astype(np.int64)
        order = suffix_order(text)
        last = text[order - 1]  # order 0 wraps to the terminator
        self.n, self.sigma = len(text), int(text.max()) + 1
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=self.sigma))))
        self.levels: list[tuple[int, np.ndarray, int]] = []
        for b in range(max(1, (self.sigma - 1).bit_length()) - 1, -1, -1):
            bit = (last >> b & 1).astype(bool)
            ones = np.zeros(self.n + 1, np.int32)
            np.cumsum(bit, out=ones[1:], dtype=np.int32)
            self.levels.append((b, ones, self.n - int(ones[-1])))
            last = np.concatenate((last[~bit], last[bit]))
        self.start = self._down(np.arange(self.sigma), np.zeros(self.sigma, np.int64))
        kept = order % sample == 0
        self.sampled = np.concatenate(([0], np.cumsum(kept)))
        self.places = order[kept]

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for b, ones, zeros in self.levels:
            r = ones[i]
            i = np.where(c >> b & 1, zeros + r, i - r)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often symbol c stands before place i of the transformed text."""
        return self._down(c, i) - self.start[c]

    def step_back(self, i: np.ndarray) -> np.ndarray:
        """The place of the suffix that begins one symbol earlier."""
        c = np.zeros(len(i), np.int64)
        for b, ones, zeros in self.levels:
            r = ones[i]
            bit = ones[i + 1] - r
            c |= bit.astype(np.int64) << b
            i = np.where(bit, zeros + r, i - r)
        return self.before[c] + i - self.start[c]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of places whose suffixes begin with each pattern; patterns are rows, padded on the left."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n)
        live = np.arange(len(patterns))
        width = patterns.shape[1]
        for k in range(width):
            live = live[k < lengths[live]]
            if not len(live):
                break
            c = patterns[live, width - 1 - k]
            known = c < self.sigma
            hi[live[~known]] = lo[live[~known]] = 0
            live, c = live[known], c[known]
            lo[live] = self.before[c] + self.rank(c, lo[live])
            hi[live] = self.before[c] + self.rank(c, hi[live])
            live = live[lo[live] < hi[live]]
        return lo, hi

    def locate(self, place: np.ndarray) -> np.ndarray:
        """Text positions of places: walk back to the next sampled one."""
        out, steps = np.empty(len(place), np.int64), 0
        left, at = np.arange(len(place)), place.copy()
        while len(left):
            hit = self.sampled[at + 1] > self.sampled[at]
            out[left[hit]] = self.places[self.sampled[at[hit]]] + steps
            left, at = left[~hit], at[~hit]
            at = self.step_back(at)
            steps += 1
        return out
