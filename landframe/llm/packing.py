"""Sequence packing by best-fit decreasing.

Documents are tokenized where they are read.  A document longer than a window is first cut
into full windows, which need no packing; what remains (one piece per document, shorter
than a window) is packed longest first, each piece into the open window with the least
room that still holds it.  A segment tree over the remaining capacities 0..window finds
that window in O(log window) steps, however many windows are open.
"""

from __future__ import annotations

import json
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from landframe.llm.common import column, documents, text_slices
from landframe.llm.token_counts import load_tokenizer
from landframe.session import materialize

QUERY_VOCABULARY = "byte_bpe_50k.json"
QUERY_WINDOW = 1024


@lru_cache(maxsize=2)
def id_encoder(path: str) -> Callable[[str], list[int]]:
    """Text -> the ids that the tokenizers library gives for a vocabulary file, without added
    begin or end tokens; once per Python worker.

    A plain byte-level BPE file (ids in merge order, no normalizer) is run by tiktoken over
    the file's own vocabulary, which gives the same ids in a third of the time (a property
    test compares them); any other file is run by tokenizers itself."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, added = spec["model"], {a["content"]: a["id"] for a in spec["added_tokens"]}
    joined = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model.get("merges", [])]
    byte_level = spec["pre_tokenizer"] or {}
    if (byte_level.get("type") == "ByteLevel" and byte_level["use_regex"] and not byte_level["add_prefix_space"]
            and spec["normalizer"] is None and [model["vocab"].get(t) for t in joined] == list(range(256, 256 + len(joined)))):
        # printable bytes stand for themselves in such files, the others for characters from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        chars = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        ranks = {bytes(chars[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
        enc = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
        return lambda text: enc.encode(text, allowed_special="all")
    tok = load_tokenizer(path)
    return lambda text: tok.encode(text, add_special_tokens=False).ids


class OpenWindows:
    """Open windows by remaining capacity, in a segment tree that counts them."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, room: int, n: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += n
            node >>= 1

    def put(self, room: int, window_id: int) -> None:
        self.open[room].append(window_id)
        self._add(room, 1)

    def take_tightest(self, need: int) -> tuple[int, int] | None:
        """(remaining capacity, window) of the tightest window with room for ``need``."""
        node, count = need + self.size, self.count
        if not count[node]:
            # climb until a right-hand neighbour holds windows, then go down leftmost
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node <<= 1
                if not count[node]:
                    node += 1
        room = node - self.size
        self._add(room, -1)
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window number and offset of each piece; ``lengths`` must be sorted descending."""
    rooms, where, offset, n = OpenWindows(window), [], [], 0
    for need in lengths:
        found = rooms.take_tightest(need)
        if found is None:
            found, n = (window, n), n + 1
        room, w = found
        where.append(w)
        offset.append(window - room)
        if room > need:
            rooms.put(room - need, w)
    return where, offset


def cut_documents(docs: DataFrame, vocabulary: str, id_col: str, text_col: str, window: int,
                  end_id: int = 0) -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens`` of every tokenized document.

    The ids are those of the tokenizer followed by ``end_id``, so a null or empty text is
    one piece of one id.  CRC-32 is over the ids as little-endian unsigned 32-bit numbers.
    """
    import pyarrow as pa

    slim = docs.select(column(docs, id_col).alias("doc_id"), F.coalesce(column(docs, text_col), F.lit("")).alias("text"))
    id_type = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        encode = id_encoder(vocabulary)
        for batch in batches:
            for part in text_slices(batch, 1_000_000):
                rows, start, length, crc, total = [], [], [], [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    ids = array("I", encode(text))
                    ids.append(end_id)
                    if sys.byteorder == "big":
                        ids.byteswap()
                    raw = memoryview(ids.tobytes())
                    for s in range(0, len(ids), window):
                        piece = raw[4 * s:4 * (s + window)]
                        rows.append(i)
                        start.append(s)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
                        total.append(len(ids))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(rows, pa.int64())), *[pa.array(x, pa.int64()) for x in (start, length, crc, total)]],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return slim.mapInArrow(run, f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long")


def pack_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                   window: int = QUERY_WINDOW, pieces_per_task: int = 100_000) -> DataFrame:
    """Pack all documents into sequences of at most ``window`` tokens.

    One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset``.  Documents are rows: repeated ids or texts are packed once per row; null texts
    count as empty; an empty table gives no rows.  ``sequence_id`` is unique, not gapless.

    Pieces are written once (tokenizing is the costly part); the short ones are dealt evenly
    over tasks of about ``pieces_per_task`` pieces, each of which packs its own, so a task's
    memory is bounded and only its last windows stay partly empty.
    """
    import pyarrow as pa

    pieces = materialize(cut_documents(docs, vocabulary, id_col, text_col, window))
    full = pieces.filter(F.col("length") == window).select(
        "*", (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = pieces.filter(F.col("length") < window)
    tasks = max(1, -(-short.count() // pieces_per_task))

    def pack(batches: Iterator) -> Iterator:
        from pyspark import TaskContext
        mine = list(batches)
        if not mine:
            return
        # equal lengths in a fixed order, so that a task run again packs alike
        rows = pa.Table.from_batches(mine).sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("ids_crc32", "ascending"), ("start", "ascending")])
        where, offset = best_fit_decreasing(rows.column("length").to_pylist(), window)
        first = TaskContext.get().partitionId() << 33
        rows = rows.append_column("sequence_id", pa.array([(first + w) * 2 for w in where], pa.int64()))
        yield from rows.append_column("offset", pa.array(offset, pa.int64())).to_batches(max_chunksize=10_000)

    schema = StructType([*short.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    packed = short.repartition(tasks).mapInArrow(pack, schema)
    return full.unionByName(packed)


def op4_packing(spark, sf_dir) -> DataFrame:
    """All documents packed into windows of 1024 tokens."""
    import public_tokenizers

    return pack_documents(documents(spark, sf_dir), public_tokenizers.path(QUERY_VOCABULARY))
