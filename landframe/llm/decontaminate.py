"""Benchmark decontamination with an FM-index per training shard.

A shard is a bounded run of the words of a partition's documents.  Words that occur in no
benchmark item can be part of no match, so a stretch of them is one separator; what is left
is indexed, every test window is searched backward through the wavelet ranks, occurrences
are located by sampled suffix positions, and the spans they cover are merged per document.
A benchmark of one block (``BLOCK_BYTES`` of text) is searched in one pass without a shuffle.
A larger one is searched block by block, each broadcast alone and released before the next,
over the documents written once; only the hits of a pass are kept, and merged at the end.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landframe.llm.common import column, documents, hold, release, text_slices, words_of
from landframe.llm.fm_index import FmIndex
from landframe.session import materialize

WINDOW = 10
#: symbols of a shard's index, and bytes of benchmark text searched at a time
SHARD_SYMBOLS = 250_000
BLOCK_BYTES = 16_000_000
#: bytes of training text handled at a time
SLICE_BYTES = 2_000_000

#: the words of the contract, in a text that is not lower-cased
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


class ItemWindows:
    """The distinct windows of a block of benchmark items, as rows of word ids."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        names: dict[str, int] = {}
        windows: dict[tuple[int, ...], set[int]] = {}
        for item_id, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if words:
                item = names.setdefault("null" if item_id is None else str(item_id), len(names))
                for i in range(max(1, len(words) - window + 1)):
                    windows.setdefault(tuple(words[i:i + window]), set()).add(item)
        self.names = np.array(list(names), dtype=object)
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.patterns = np.zeros((len(windows), window), np.int64)
        for row, w in zip(self.patterns, windows):
            row[window - len(w):] = w
        # items of each window, flat, with the place where each window's begin
        self.items = np.array([i for w in windows.values() for i in w], np.int64)
        self.first_item = np.r_[0, np.cumsum([len(w) for w in windows.values()], dtype=np.int64)]
        self.window = window

    def encode(self, text: str | None) -> np.ndarray:
        """Word ids of a text, 0 for words of no item; its words are kept no longer than this."""
        words = words_of(text)
        return np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int32, len(words))

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, number of words, window) of every occurrence in the word ids of texts
        that stand one after another, each followed by a gap (0)."""
        kept = np.flatnonzero((ids != 0) | (np.r_[np.int32(0), ids[:-1]] != 0)).astype(np.int32)
        sym, found = ids[kept], []
        for a in range(0, len(sym), SHARD_SYMBOLS):
            # shards overlap, so that no window is cut; those seen twice are merged later
            index = FmIndex(np.r_[sym[a:a + SHARD_SYMBOLS + self.window - 1], np.int32(0)], len(self.vocabulary))
            which, lo, hi = index.search(self.patterns, self.lengths)
            n = hi - lo
            at = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            which = np.repeat(which, n)
            found.append((kept[a + index.locate(at)].astype(np.int64), self.lengths[which], which))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3


def find_contamination(texts: list[str | None], blocks: list[ItemWindows]) -> list[tuple[int, int, list[str], list[tuple[int, int]]]]:
    """Of each text: words, words hit, items found and the merged spans of hit words."""
    cover, ends, items = None, np.zeros(0, np.int64), [set() for _ in texts]
    for block in blocks:
        encoded = [block.encode(t) for t in texts]
        ends = np.cumsum([len(d) + 1 for d in encoded], dtype=np.int64)
        ids = np.zeros(int(ends[-1]) if texts else 0, np.int32)
        for d, end in zip(encoded, ends):
            ids[end - 1 - len(d):end - 1] = d
        del encoded
        cover = np.zeros(len(ids) + 1, np.int32) if cover is None else cover
        first, length, which = block.find(ids)
        np.add.at(cover, first, 1)
        np.add.at(cover, first + length, -1)
        owner = np.searchsorted(ends, first, side="right")
        for doc, w in np.unique(np.stack([owner, which], 1), axis=0):
            items[doc].update(block.names[block.items[block.first_item[w]:block.first_item[w + 1]]])
    out, start = [], 0
    hit = None if cover is None else np.cumsum(cover) > 0
    for end, found in zip(ends.tolist(), items):
        spans = []
        if found:
            edge = np.flatnonzero(np.diff(np.r_[0, hit[start:end - 1].astype(np.int8), 0]))
            spans = [(int(a), int(b)) for a, b in zip(edge[::2], edge[1::2])]
        out.append((end - 1 - start, sum(b - a for a, b in spans), sorted(found), spans))
        start = end
    return out


def benchmark_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> tuple[int, Callable]:
    """The number of blocks of about ``BLOCK_BYTES`` of text that a benchmark is cut into by a
    hash of the item id, and a function that broadcasts one of them.  The driver and every task
    hold one block at a time."""
    slim = benchmark.select(column(benchmark, id_col).cast("string").alias("item"), column(benchmark, text_col).alias("text"))
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_BYTES))

    def block(b: int):
        rows = slim.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == b).collect()
        return benchmark.sparkSession.sparkContext.broadcast(ItemWindows([tuple(r) for r in rows], window))

    return n, block


_FOUND = "n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>"


def _search(docs: DataFrame, tests, only_hits: bool) -> DataFrame:
    """``key`` of ``docs`` (key, text) with what a broadcast block finds in each text."""
    import pyarrow as pa

    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for part in text_slices(batch, SLICE_BYTES):
                found = find_contamination(part.column("text").to_pylist(), [tests.value])
                at = [i for i, f in enumerate(found) if f[3] or not only_hits]
                found = [found[i] for i in at]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(pa.array(at, pa.int64())), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                     pa.array([f[2] for f in found], pa.list_(pa.string())),
                     pa.array([[{"start": a, "end": b} for a, b in f[3]] for f in found], span_type)],
                    names=["key", "n_words", "n_hit", "items", "spans"])

    return docs.select("key", "text").mapInArrow(run, f"key {docs.schema['key'].dataType.simpleString()}, {_FOUND}")


def merged_spans(spans: Column) -> Column:
    """Sorted spans without overlaps or touching ends."""
    empty = F.array().cast("array<struct<start:long,end:long>>")

    def step(done, s):
        last = F.try_element_at(done, F.lit(-1))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(last.isNotNull() & (s["start"] <= last["end"]), F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))).otherwise(
            F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), empty, step)


def _hits_of_all_blocks(rows: DataFrame, n: int, block: Callable) -> DataFrame:
    """``key, items, spans`` of the rows (key, text) in which some block is found, one pass a block."""
    found = None
    for b in range(n):
        tests = block(b)
        hits = materialize(_search(rows, tests, True).select("key", "items", "spans"))
        tests.destroy()
        found = hits if found is None else found.unionByName(hits)
    return materialize(found.groupBy("key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), merged_spans(F.flatten(F.collect_list("spans"))).alias("spans")))


def find_benchmark_overlap(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: ``doc_id, n_words, n_hit, items`` (ids, sorted as strings)
    and ``spans``, the merged removal spans in words from 0, end exclusive.

    Null texts have no words; items without words find nothing; a null item id counts as
    ``null``, and items of one id count as one; an empty benchmark finds nothing.
    """
    n, block = benchmark_blocks(benchmark)
    given = docs.select(column(docs, id_col).alias("key"), column(docs, text_col).alias("text"))
    if n == 1:
        return _search(given, block(0), False).withColumnRenamed("key", "doc_id")
    rows = materialize(given.select(F.col("key").alias("doc_id"), "text", F.monotonically_increasing_id().alias("key")))
    hits = _hits_of_all_blocks(rows, n, block)
    empty = benchmark.sparkSession.sparkContext.broadcast(ItemWindows([]))
    words = _search(rows, empty, False).select("key", "n_words")
    found = rows.select("key", "doc_id").join(words, "key").join(hits, "key", "left")
    items, spans = F.coalesce("items", F.array().cast("array<string>")), F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>"))
    return found.select("doc_id", "n_words", F.aggregate(spans, F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"]).alias("n_hit"),
                        items.alias("items"), spans.alias("spans"))


def remove_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    places = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:places[a][0]])
        at = places[b - 1][1]
    return "".join([*out, text[at:]])


def _cut_texts(rows: DataFrame, cut) -> DataFrame:
    """``rows`` (with ``text``) after ``cut(batch)``, which gives the new texts and the rows to keep."""
    import pyarrow as pa

    names = rows.columns

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for part in text_slices(batch, SLICE_BYTES):
                texts, keep = cut(part)
                columns = [pa.array(texts, part.schema.field("text").type) if n == "text" else part.column(n) for n in names]
                yield pa.RecordBatch.from_arrays([c.take(pa.array(keep, pa.int64())) for c in columns], names=names)

    return rows.mapInArrow(run, rows.schema)


def remove_benchmark_overlap(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the removal spans cut from their texts, again and again until a text
    holds no window (the words around a cut may form one).  Clean rows are unchanged; a
    document of which no word is left is dropped.  All columns are kept, whatever their names,
    null texts too; repeated rows are cut alike; an empty table stays empty."""
    n, block = benchmark_blocks(benchmark)
    held = hold(docs, text_col)
    if n == 1:
        tests = block(0)

        def cut_all(part):
            texts = part.column("text").to_pylist()
            todo, gone = list(range(len(texts))), set()
            while todo:
                found = find_contamination([texts[i] for i in todo], [tests.value])
                todo = [i for i, f in zip(todo, found) if f[3]]
                for i, f in zip(todo, [f for f in found if f[3]]):
                    texts[i] = remove_words(texts[i], f[3])
                    if f[1] == f[0]:
                        gone.add(i)
            return texts, [i for i in range(len(texts)) if i not in gone]

        return release(_cut_texts(held, cut_all), docs, text_col)

    def cut_spans(part):
        texts = part.column("text").to_pylist()
        spans = [[(s["start"], s["end"]) for s in x] for x in part.column("spans").to_pylist()]
        keep = [i for i, t in enumerate(texts) if sum(b - a for a, b in spans[i]) < len(words_of(t))]
        return [remove_words(t, x) for t, x in zip(texts, spans)], keep

    pending, done = materialize(held.withColumn("key", F.monotonically_increasing_id())), None
    while True:
        hits = _hits_of_all_blocks(pending, n, block)
        clean = pending.join(hits, "key", "left_anti")
        done = clean if done is None else done.unionByName(clean)
        if hits.isEmpty():
            return release(done, docs, text_col)
        pending = materialize(_cut_texts(pending.join(hits.select("key", "spans"), "key"), cut_spans).select(*pending.columns))


def op5_decontamination(spark, sf_dir) -> DataFrame:
    """Benchmark windows in all documents."""
    found = find_benchmark_overlap(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH lowered AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(10, len(w)) AS n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1),
        lambda i: array_to_string(w[i:i + 9], ' '))) AS g FROM items WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT r, n, unnest(range(0, len(w) - n + 1)) AS p,
        unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g
       FROM lowered, sizes WHERE len(w) >= n),
occ AS (SELECT r, p, n, item FROM dw JOIN win USING (n, g)),
hits AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS k FROM occ) GROUP BY r),
its AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM occ GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM lowered LEFT JOIN hits USING (r) LEFT JOIN its USING (r)"""
