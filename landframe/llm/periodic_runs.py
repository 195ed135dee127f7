"""Periodic runs of words, found online by dyadic square catching.

A square of period ``q`` (a word sequence written twice) holds, in its first half, a whole
aligned block of ``L`` words for every power of two ``L`` with ``2 L <= q + 1``.  So each
completed block of ``L`` words becomes a catcher: while words are appended, it watches the
windows of ``L`` words that start ``2 L`` to ``4 L - 1`` words behind its own start (a block of
one word also the next word).  A window equal to the block at distance ``q`` gives a stretch
where words ``q`` apart are equal; comparing suffixes backward and appended words forward gives
the whole stretch, and with ``q`` or more of it a square.  Squares of one period that meet are
one stretch, hence one run.

Every appended window is compared with exactly two blocks a level, so the comparisons are
``2 n log n`` at most, done as array operations for all words of one ``append``; appending word
by word gives the same runs.  Equal windows are found by 64-bit fingerprints and every stretch
is then compared word by word.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landframe.llm.common import column, documents, text_slices

_MIX = np.uint64(0x9E3779B97F4A7C15)
_TURN = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


class Run(NamedTuple):
    start: int
    length: int
    period: int


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _HALF)) * _TURN
    return x ^ (x >> _HALF)


class SquareCatcher:
    """Runs (maximal stretches with a period, at least twice as long) of words appended in any
    portions; ``runs`` gives those of all words so far, each with its smallest period."""

    def __init__(self):
        self.words = np.empty(0, np.int64)
        #: fingerprints of all windows of 1, 2, 4, ... words, by start
        self.levels: list[np.ndarray] = []
        #: stretches with words q apart equal: (start, end, q) over [start, end); the open ones
        #: reach the last word
        self.closed: list[tuple[int, int, int]] = []
        self.open: list[tuple[int, int, int]] = []

    def append(self, words: np.ndarray) -> None:
        before = len(self.words)
        if not len(words):
            return
        self.words = np.concatenate([self.words, words]) if before else np.asarray(words, np.int64)
        n = len(self.words)
        self._advance()
        level, size = 0, 1
        while 3 * size <= n or size == 1:
            self._fingerprint(level, size)
            first = max(before - size + 1, 0)  # windows that the new words complete
            self._catch(size, first, level)
            level, size = level + 1, 2 * size

    def _advance(self) -> None:
        """Open stretches go on over the appended words."""
        ongoing, self.open = self.open, []
        for start, end, q in ongoing:
            self._keep(start, self._forward(end, q), q)

    def _keep(self, start: int, end: int, q: int) -> None:
        if end + q == len(self.words):
            self.open.append((start, end, q))
        elif end - start >= q:
            self.closed.append((start, end, q))

    def _forward(self, at: int, q: int) -> int:
        """First position from ``at`` on whose word differs from the one ``q`` later."""
        words, n, step = self.words, len(self.words), 16
        while at + q < n:
            here = min(step, n - q - at)
            equal = words[at:at + here] == words[at + q:at + q + here]
            if not equal.all():
                return at + int(equal.argmin())
            at, step = at + here, min(2 * step, 1 << 16)
        return at

    def _backward(self, at: int, q: int) -> int:
        """Smallest start of the stretch of equal words that ends before ``at``."""
        words, step = self.words, 16
        while at > 0:
            here = min(step, at)
            equal = words[at - here:at] == words[at - here + q:at + q]
            if not equal.all():
                return at - int(equal[::-1].argmin())
            at, step = at - here, min(2 * step, 1 << 16)
        return at

    def _fingerprint(self, level: int, size: int) -> None:
        """Fingerprints of the windows of ``size`` words that are not there yet."""
        if level == len(self.levels):
            self.levels.append(np.empty(0, np.uint64))
        old, n = self.levels[level], len(self.words) - size + 1
        if len(old) >= n:
            return
        if not level:
            new = _mixed((self.words[len(old):n].astype(np.uint64) + np.uint64(1)) * _MIX)
        else:
            below, half = self.levels[level - 1], size // 2
            new = _mixed(below[len(old):n] * _MIX + below[len(old) + half:n + half])
        self.levels[level] = np.concatenate([old, new]) if len(old) else new

    def _catch(self, size: int, first: int, level: int) -> None:
        """Windows from ``first`` on that equal the blocks watching them become stretches."""
        prints = self.levels[level]
        starts = np.arange(first, len(prints))
        found = []
        near = (starts - 2 * size) // size * size  # the nearest block of the two, aligned
        for block in (near, near - size, *([starts - 1] if size == 1 else [])):
            lo = int(np.searchsorted(block, 0))
            hit = np.flatnonzero(prints[block[lo:]] == prints[starts[lo:]]) + lo
            if len(hit):
                found.append(np.stack([starts[hit] - block[hit], block[hit]]))
        if not found:
            return
        q, s = np.concatenate(found, axis=1)
        if (known := self._known_ends(size)) is not None:
            # both copies inside a run of a period of at most ``size``: a multiple of its period
            fresh = known[s] < s + q + size
            q, s = q[fresh], s[fresh]
        if not len(q):
            return
        order = np.lexsort((s, q))
        q, s = q[order], s[order]
        # blocks next to each other that match at one distance are one stretch
        heads = np.flatnonzero(np.concatenate([[True], (np.diff(q) != 0) | (np.diff(s) > size)]))
        tails = np.concatenate([heads[1:], [len(q)]]) - 1
        open_ends = {(period, start) for start, _, period in self.open}
        for period, a, b in zip(q[heads].tolist(), s[heads].tolist(), s[tails].tolist()):
            at = a
            while at <= b:
                end = self._forward(at, period)
                if end > at and (period, (start := self._backward(at, period))) not in open_ends:
                    self._keep(start, end, period)
                # past b, but for equal fingerprints of different windows
                at = max(at, end) // size * size + size

    def _known_ends(self, size: int) -> np.ndarray | None:
        """For each position the furthest end of a run around it with a period up to ``size``
        and three periods or more; None without such runs."""
        ends = None
        for start, end, q in (*self.closed, *self.open):
            if q <= size and end - start >= 2 * q:
                if ends is None:
                    ends = np.zeros(len(self.words), np.int64)
                np.maximum(ends[start:end + q], end + q, out=ends[start:end + q])
        return ends

    def runs(self, min_length: int = 2, min_periods: int = 2) -> list[Run]:
        """Runs of at least ``min_length`` words and ``min_periods`` periods, by start and period."""
        shortest: dict[tuple[int, int], int] = {}
        for start, end, q in (*self.closed, *self.open):
            if end - start >= q:
                span = (start, end + q)
                shortest[span] = min(q, shortest.get(span, q))
        return sorted(Run(a, b - a, q) for (a, b), q in shortest.items()
                      if b - a >= min_length and b - a >= min_periods * q)


def word_ids(text: str | None) -> tuple[list[bytes], np.ndarray]:
    """Distinct words of a text (between ASCII white space, as UTF-8) and each word's number.
    Long texts are split a stretch at a time, so only distinct words are kept as objects."""
    data, numbers, parts, at = (text or "").encode("utf-8", "replace"), {}, [], 0
    while at < len(data):
        end = len(data)
        if end - at > 1_000_000:
            blank = _BLANK.search(data, at + 1_000_000)
            end = blank.start() if blank else end
        words = data[at:end].split()
        parts.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)))
        at = end
    return list(numbers), np.concatenate(parts) if parts else np.empty(0, np.int64)


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Mask of the words that no run holds after its first period."""
    kept = np.ones(n, bool)
    for r in runs:
        kept[r.start + r.period:r.start + r.length] = False
    return kept


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest exponent (ties: smallest start, then period)."""
    return min(runs, key=lambda r: (-Fraction(r.length, r.period), r.start, r.period), default=None)


def find_runs(ids: np.ndarray, min_length: int = 2, min_periods: int = 2) -> list[Run]:
    catcher = SquareCatcher()
    catcher.append(ids)
    return catcher.runs(min_length, min_periods)


def map_runs(docs: DataFrame, digest, schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``digest(doc_id, text)`` of every row, a tuple of ``schema``; no shuffle, a bounded
    slice of texts at a time."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    slim = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))
    out = docs.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for part in text_slices(batch):
                rows = [digest(*row) for row in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return slim.mapInArrow(run, out)


def periodic_runs(docs: DataFrame, min_length: int = 6, min_periods: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per run: ``doc_id``, ``start``, ``length``, ``period`` (in words, from 0).

    Null and empty texts have no runs; every row is scanned for itself, so repeated rows repeat
    their runs; an empty table gives none.  Other columns are ignored.  A text takes memory for
    about 8 bytes a word and power of two below its length.
    """
    schema = "doc_id {}, runs array<struct<start:long,length:long,period:long>>".format(
        docs.select(column(docs, id_col)).schema[0].dataType.simpleString())

    def digest(doc_id, text) -> tuple:
        return doc_id, [r._asdict() for r in find_runs(word_ids(text)[1], min_length, min_periods)]

    return map_runs(docs, digest, schema, id_col, text_col).select("doc_id", F.explode("runs").alias("r")).select("doc_id", "r.*")


def planted(ids: np.ndarray, doc_id: int | None) -> np.ndarray:
    """The contract's words: in a tenth of the documents a tail is made periodic."""
    h, n = zlib.crc32(str(doc_id).encode()), len(ids)
    if doc_id is None or h % 10 or not n:
        return ids
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return ids[np.where(at < a, at, a + (at - a) % p)]


def op12_periodic_runs(spark, sf_dir) -> DataFrame:
    """Runs of at least 6 words and 4 periods in every document."""
    def digest(doc_id, text) -> tuple:
        words, ids = word_ids(text)
        ids = planted(ids, doc_id)
        runs = find_runs(ids, 6, 4)
        top = strongest(runs)
        kept = ids[kept_words(len(ids), runs)].tolist() if runs else ids.tolist()
        lines = "".join(f"{r.start},{r.length},{r.period}\n" for r in sorted(runs, key=lambda r: (r.start, r.period)))
        best = (top.start, top.length, top.period, 1000 * top.length // top.period) if top else (None,) * 4
        return (doc_id, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(),
                hashlib.sha256(b" ".join([words[i] for i in kept])).hexdigest())

    return map_runs(documents(spark, sf_dir), digest, "doc_id long, n_runs long, start long, length long, period long, "
                    "exponent_milli long, runs_sha256 string, collapsed_sha256 string")
