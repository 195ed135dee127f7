"""Word-shingle sets, min-wise sketches and chosen paths of texts, in NumPy."""

from __future__ import annotations

import math

import numpy as np
import xxhash

from landframe.llm.common import words_of

SHINGLE = 5
SKETCH = 64
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xD6E8FEB86659FD93)
_rng = np.random.default_rng(7)
_SKETCH_XOR = _rng.integers(0, 2**32, SKETCH, dtype=np.uint64).astype(np.uint32)
_SKETCH_MUL = _rng.integers(0, 2**32, SKETCH, dtype=np.uint64).astype(np.uint32) | np.uint32(1)

_words: dict[bytes, int] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = (x ^ (x >> np.uint64(32))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * _ODD2
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words; a shorter text has one
    shingle of all its words, a text without words none."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    if len(_words) > 100_000:  # hashes only, made anew when needed
        _words.clear()
    hashes = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        h = _words.get(w)
        if h is None:
            h = _words[w] = xxhash.xxh64_intdigest(w)
        hashes[i] = h
    n = min(size, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for j in range(n):
        out = mix(out + hashes[j:len(words) - n + 1 + j])
    return np.unique(out)


def set_id(tokens: np.ndarray) -> bytes:
    """128-bit name of a set: equal sets, equal names."""
    return xxhash.xxh3_128_digest(tokens.tobytes())


def sketch(tokens: np.ndarray) -> bytes:
    """One byte of each of ``SKETCH`` min-wise hashes."""
    t = (tokens >> np.uint64(32)).astype(np.uint32)
    out = np.empty(SKETCH, np.uint8)
    for k in range(SKETCH):
        out[k] = ((t ^ _SKETCH_XOR[k]) * _SKETCH_MUL[k]).min() & np.uint32(0xFF)
    return out.tobytes()


def runs_for(recall: float, depth: int = 1) -> int:
    """Runs until a pair at the threshold shares a path of ``depth`` tokens with probability
    ``recall``.

    Two sets of sizes n >= m with Jaccard similarity t share at least t * n tokens, each
    chosen by both with probability 1 / (t * n): a shared path is prolonged by one shared
    choice in the mean, by none with probability 1 / e at most.  A run misses the pair if this
    branching dies out before ``depth``: 0.368, 0.531 and 0.626 for one, two and three levels."""
    miss = 0.0
    for _ in range(depth):
        miss = math.exp(miss - 1)
    return math.ceil(math.log(1 - recall) / math.log(miss) - 1e-9)


def sketch_cutoff(threshold: float, miss: float) -> int:
    """Most equal sketch bytes to ask for so that a pair at the threshold has fewer with
    probability ``miss`` at most (binomial; equal bytes of unequal minima only help)."""
    below, k = (1 - threshold) ** SKETCH, 0
    while below <= miss and k < SKETCH:
        k += 1
        below += math.comb(SKETCH, k) * threshold ** k * (1 - threshold) ** (SKETCH - k)
    return k


def chosen_paths(tokens: np.ndarray, threshold: float, runs: int, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(path, parent) of each level: a path is prolonged by every token that a hash of path
    and token picks with probability 1 / (threshold * size), the same way for all sets."""
    limit = np.uint64(min(2**64 - 1, int(2**64 / (threshold * len(tokens)))))
    parents = mix(np.arange(1, runs + 1, dtype=np.uint64) * _ODD)
    levels = []
    for _ in range(depth):
        path, at = [], []
        step = max(1, 2_000_000 // len(tokens))
        for a in range(0, len(parents), step):
            value = mix(tokens[None, :] ^ parents[a:a + step, None])
            row, col = np.nonzero(value < limit)
            at.append(parents[a:a + step][row])
            path.append(mix(value[row, col] + parents[a:a + step][row]))
        path, at = np.concatenate(path), np.concatenate(at)
        levels.append((path.view(np.int64), at.view(np.int64)))
        parents = path
        if not len(path):
            parents = np.zeros(0, np.uint64)
            levels += [(np.zeros(0, np.int64),) * 2] * (depth - len(levels))
            break
    return levels


def similar_forest(sketches: np.ndarray, sizes: np.ndarray, threshold: float, need: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the sets whose sketches let them be similar: sizes fit,
    and ``need`` bytes of the sketches or more are equal."""
    left, edges = np.arange(len(sizes)), []
    while len(left):
        reach = [left[0]]
        left = left[1:]
        while reach and len(left):
            u = reach.pop()
            near = (sketches[left] == sketches[u]).sum(1) >= need
            near &= np.minimum(sizes[left], sizes[u]) >= threshold * np.maximum(sizes[left], sizes[u]) - 1e-9
            found = left[near]
            if len(found):
                edges += [(u, v) for v in found]
                reach += list(found)
                left = left[~near]
    return edges


def similar_pairs(sets: list[np.ndarray], threshold: float, split: int | None = None) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Exact Jaccard join of a group: the number of partners of each set and a spanning
    forest of the links.  With ``split``, only pairs across that place are compared."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    token, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(m), sizes)
    shared = count[column] > 1  # a token of one set alone is in no intersection
    row, column = row[shared], (np.cumsum(count > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    left, right = (slice(0, m), slice(0, m)) if split is None else (slice(0, split), slice(split, m))
    inter = np.zeros((left.stop - left.start, right.stop - right.start), np.float32)
    width = 2048
    for c in range(0, int(count.__gt__(1).sum()), width):
        a, b = np.searchsorted(column, [c, c + width])
        x = np.zeros((m, width), np.float32)
        x[row[a:b], column[a:b] - c] = 1
        inter += x[left] @ x[right].T
    union = sizes[left][:, None] + sizes[right][None, :] - inter
    linked = inter >= threshold * union - 1e-6
    if split is None:
        np.fill_diagonal(linked, False)
        degree = linked.sum(1)
    else:
        degree = np.concatenate([linked.sum(1), linked.sum(0)])
    neighbours = (lambda u: np.flatnonzero(linked[u])) if split is None else (
        lambda u: np.flatnonzero(linked[u]) + split if u < split else np.flatnonzero(linked[:, u - split]))
    seen, edges = np.zeros(m, bool), []
    for start in np.flatnonzero(degree):
        reach = [] if seen[start] else [start]
        seen[start] = True
        while reach:
            u = reach.pop()
            new = neighbours(u)
            new = new[~seen[new]]
            seen[new] = True
            edges += [(u, v) for v in new]
            reach += list(new)
    return degree, edges
