"""Token counts: batched encoding inside Arrow functions that return lengths only.

Texts are cut at ASCII white space.  This needs a vocabulary whose normaliser and
pre-tokenizer drop white space, so that no token reaches across it; then the counts of the
parts add up to the count of the whole text (a property test checks it).  The assumption is
tried on the file when it is loaded; a vocabulary that fails it gets whole texts.  The distinct
parts of a slice of texts are encoded once, in batches of about equal bytes whatever the texts'
lengths, and their lengths are kept for the next slices.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landframe.llm.common import by_bytes, column, documents, text_slices

QUERY_VOCABULARY = "word_bpe_49k.json"
QUERY_LIMIT = 2048
#: parts whose lengths a task keeps
KNOWN_PARTS = 300_000
_BLANK = re.compile(r"[ \t\n\r\x0b\x0c]")


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    """The tokenizer of a vocabulary file, once per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


@lru_cache(maxsize=4)
def blanks_split(path: str) -> bool:
    """Whether white space, of any kind and number, only separates tokens of the vocabulary."""
    tok = load_tokenizer(path)

    def count(text: str) -> int:
        return len(tok.encode(text, add_special_tokens=False))

    ends = ["a", "Zoë", "7", "'", "s", "!?", "\u0301", "漢", "<|"]
    return all(count(a + blank + b) == count(a) + count(b) for blank in " \t\n\r\x0b\x0c" for a in ends for b in ends) and count(" \n ") == 0


def split_at_blanks(text: str, piece: int) -> list[str]:
    """Parts of about ``piece`` characters, each cut just before white space (a stretch without
    any stays whole)."""
    parts, start = [], 0
    while len(text) - start > piece:
        cut = _BLANK.search(text, start + piece)
        if cut is None:
            break
        parts.append(text[start:cut.start()])
        start = cut.start()
    parts.append(text[start:])
    return parts


def _encoded_lengths(tok, texts: list[str], batch_bytes: int) -> list[int]:
    sizes = [len(t) if t.isascii() else len(t.encode("utf-8", "replace")) for t in texts]
    return [len(e) for a, b in by_bytes(sizes, batch_bytes) for e in tok.encode_batch_fast(texts[a:b], add_special_tokens=False)]


def token_lengths(texts: list[str], path: str, piece: int, batch_bytes: int, known: dict[bytes, int] | None = None) -> list[int]:
    """Tokens of each text; ``known`` holds the lengths of parts seen before and takes new ones.
    Texts longer than ``piece`` are cut into their parts a stretch at a time."""
    tok = load_tokenizer(path)
    if not blanks_split(path):
        return _encoded_lengths(tok, texts, batch_bytes)
    known = {} if known is None else known
    totals = [0] * len(texts)
    todo, size = [], 0
    stretches = ((i, s) for i, t in enumerate(texts) for s in (split_at_blanks(t, piece) if len(t) > piece else (t,)))

    def count() -> None:
        if len(known) > KNOWN_PARTS:
            known.clear()
        new = list({w for _, words in todo for w in words if w not in known})
        known.update(zip(new, _encoded_lengths(tok, [w.decode("utf-8", "replace") for w in new], batch_bytes)))
        for i, words in todo:
            totals[i] += sum(map(known.__getitem__, words))

    for i, stretch in stretches:
        todo.append((i, stretch.encode("utf-8", "replace").split()))  # bytes: at ASCII white space
        size += len(stretch)
        if size > batch_bytes:
            count()
            todo, size = [], 0
    count()
    return totals


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = QUERY_LIMIT, piece: int = 16_384, batch_bytes: int = 500_000) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``.

    A null text counts as empty (0 bytes, 0 tokens); ids may be null or repeated, every
    row is counted for itself.  No shuffle: the result keeps the scan's partitions.
    """
    import pyarrow as pa

    slim = docs.select(column(docs, id_col).alias("doc_id"), F.coalesce(column(docs, text_col), F.lit("")).alias("text"))
    id_type = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow.compute as pc
        known: dict[bytes, int] = {}
        for batch in batches:
            for part in text_slices(batch):
                counts = token_lengths(part.column("text").to_pylist(), vocabulary, piece, batch_bytes, known)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pc.cast(pc.binary_length(part.column("text")), pa.int64()),
                     pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return slim.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")


def op9_token_counts(spark, sf_dir) -> DataFrame:
    """Tokens of every document under the word-level BPE vocabulary."""
    import public_tokenizers

    return count_tokens(documents(spark, sf_dir), public_tokenizers.path(QUERY_VOCABULARY))
