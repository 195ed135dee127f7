"""FM-index over a sequence of word ids, in NumPy.

Symbol 0 is a separator: separators differ from each other (the earlier one is smaller), so
no suffix comparison reaches beyond the next one, and no pattern matches across it.
"""

from __future__ import annotations

import numpy as np


def suffix_array(sym: np.ndarray, bits: int) -> np.ndarray:
    """Suffix array of ``sym`` (which ends with 0): as many symbols as fit 62 bits are sorted
    at once, and what is still tied is doubled (few suffixes, as separators are frequent)."""
    n, width = len(sym), max(1, 62 // bits)
    key, open_ = np.zeros(n, np.int64), np.ones(n, bool)
    for j in range(min(width, n)):
        ahead = np.zeros(n, np.int64)
        ahead[:n - j] = sym[j:]
        ahead[~open_] = 0
        key = key << bits | ahead
        open_ &= ahead != 0
    # stable: ties that hold a separator are settled by position, as separators are
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    head = np.r_[True, ordered[1:] != ordered[:-1]] | ~open_[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    h = width
    while len(tied := np.flatnonzero(~(head & np.r_[head[1:], True]))):
        pos = order[tied]
        first, then = rank[pos], rank[pos + h]
        by = np.lexsort((then, first))
        pos, first, then = pos[by], first[by], then[by]
        new = np.r_[True, (first[1:] != first[:-1]) | (then[1:] != then[:-1])]
        order[tied], head[tied] = pos, new
        rank[pos] = np.maximum.accumulate(np.where(new, tied, 0))
        h *= 2
    return order


class FmIndex:
    """Backward search through a wavelet matrix; positions by sampled suffix entries."""

    def __init__(self, sym: np.ndarray, n_symbols: int, sample: int = 8):
        self.n, self.bits = len(sym), max(1, int(n_symbols).bit_length())
        order = suffix_array(sym, self.bits)
        self.below = np.r_[0, np.cumsum(np.bincount(sym, minlength=n_symbols + 1))]
        self.bwt = sym[order - 1]  # position 0 follows the last separator
        before = np.r_[0, sym[:-1]]
        # runs begin at a sampled position, so that no walk crosses a separator
        sampled = (order % sample == 0) | (before[order] == 0)
        self.sampled, self.sample_at = sampled, np.cumsum(sampled) - 1
        self.samples = order[sampled]
        self.levels = []
        seq = self.bwt
        for level in range(self.bits - 1, -1, -1):
            one = (seq >> level & 1).astype(bool)
            ones = np.zeros(self.n + 1, np.int32)
            np.cumsum(one, out=ones[1:])
            self.levels.append((level, ones, self.n - int(ones[-1])))
            seq = np.concatenate([seq[~one], seq[one]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``c`` occurs in the first ``i`` symbols of the transform."""
        start = np.zeros_like(i)
        for level, ones, zeros in self.levels:
            one = (c >> level & 1).astype(bool)
            s, e = ones[start], ones[i]
            start, i = np.where(one, zeros + s, start - s), np.where(one, zeros + e, i - e)
        return i - start

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, from, to) of every pattern that occurs; ``patterns`` are right-aligned."""
        which = np.flatnonzero(lengths > 0)
        lo, hi = np.zeros(len(which), np.int64), np.full(len(which), self.n, np.int64)
        done: list[tuple] = []
        for j in range(patterns.shape[1]):
            ended = lengths[which] == j
            if ended.any():
                done.append((which[ended], lo[ended], hi[ended]))
                which, lo, hi = which[~ended], lo[~ended], hi[~ended]
            if not len(which):
                break
            c = patterns[which, patterns.shape[1] - 1 - j]
            lo, hi = self.below[c] + self.rank(c, lo), self.below[c] + self.rank(c, hi)
            live = hi > lo
            which, lo, hi = which[live], lo[live], hi[live]
        done.append((which, lo, hi))
        return tuple(np.concatenate(x) for x in zip(*done))

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Positions of suffix array entries: walk back to the nearest sampled one."""
        at, steps, out = at.copy(), 0, np.empty(len(at), np.int64)
        left = np.arange(len(at))
        while len(left):
            here = self.sampled[at]
            out[left[here]] = self.samples[self.sample_at[at[here]]] + steps
            left, at = left[~here], at[~here]
            c = self.bwt[at]
            at = self.below[c] + self.rank(c, at)
            steps += 1
        return out
