"""Secret scan: pattern rules plus a token-efficiency test.

The base rules find assignments, access keys and hexadecimal strings.  The method adds long
unbroken strings that a tokenizer needs unusually many tokens for: text that a byte-pair
vocabulary has learnt takes three or four characters a token, a random string hardly two.
Known digests (hexadecimal strings of a digest's length, UUIDs) and identifiers (numbers and
words that pass the token test themselves, joined by separators) are taken out before the
test.  Where the whole string passes, its parts between separators and the stretches of
neighbouring parts are tested, so that words in front hide no secret.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landframe.llm.common import column, documents, text_slices

QUERY_VOCABULARY = "byte_bpe_50k.tiktoken"
MAX_CHARS_PER_TOKEN = 2.0

#: The base rules of the contract, in its order
KINDS = ["assign", "access", "hex"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")

METHOD_KIND = "random"
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
DIGEST_LENGTHS = {32, 40, 48, 56, 64, 96, 128}
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
UUID_INSIDE = re.compile(r"(?<![A-Za-z0-9])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![A-Za-z0-9])")
PART = re.compile(r"[A-Za-z0-9]+")
LEAST = 20  # characters of a candidate
#: letters that are too few for the token test, such as "id" or "src"
SHORT_WORD = 4
#: characters encoded at a time, so that a very long string takes time in proportion
PIECE = 2_000


@lru_cache(maxsize=2)
def encoding(path: str):
    """The tiktoken encoding of a ranks file, once per Python worker."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def is_digest(s: str) -> bool:
    return bool(len(s) in DIGEST_LENGTHS and DIGEST.match(s))


def n_tokens(s: str, path: str) -> int:
    return sum(len(encoding(path).encode_ordinary(s[i:i + PIECE])) for i in range(0, len(s), PIECE))


def excess(part: str, path: str, max_ratio: float) -> float:
    """Characters by which a part's tokens exceed what the token test allows; numbers and
    short words have none."""
    over = max_ratio * n_tokens(part, path) - len(part)
    plain = part.isdigit() or len(part) < SHORT_WORD and part.isalpha()
    return min(0.0, over) if plain else over


def random_stretches(s: str, path: str, max_ratio: float) -> list[tuple[int, int]]:
    """Where a candidate fails the token test: all of it, or stretches of ``LEAST`` characters
    or more from one part to another, those of the largest excess, without digests and UUIDs."""
    if is_digest(s) or UUID.match(s):
        return []
    barred = [m.span() for m in UUID_INSIDE.finditer(s)]
    parts = []
    for m in PART.finditer(s):
        known = is_digest(m[0]) or any(a <= m.start() < b for a, b in barred)
        parts.append((m.start(), m.end(), float("-inf") if known else excess(m[0], path, max_ratio)))
    words = all(s[a:b].isalpha() or s[a:b].isdigit() for a, b, _ in parts)
    if words and not any(x > 0 for _, _, x in parts):
        return []
    if len(s) < max_ratio * n_tokens(s, path):
        return [(0, len(s))]
    found, start, total, best = [], None, 0.0, None
    for a, b, x in [*parts, (0, 0, float("-inf"))]:
        if start is None and x > 0:
            start, total, best = a, 0.0, (0.0, a, a)
        if start is not None:
            total += x
            if total > best[0]:
                best = (total, start, b)
            if total <= 0:
                if best[2] - best[1] >= LEAST and best[2] - best[1] < max_ratio * n_tokens(s[best[1]:best[2]], path):
                    found.append(best[1:])
                start = None
    return found


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    lower = text.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def random_spans(text: str, path: str, max_ratio: float) -> list[tuple[int, int, str]]:
    return [(m.start() + a, m.start() + b, METHOD_KIND) for m in CANDIDATE.finditer(text) for a, b in random_stretches(m[0], path, max_ratio)]


def scan_secrets(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 max_chars_per_token: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """One row per document row: ``doc_id`` and ``spans``, an array of ``(kind, start, end)``
    in code points, end exclusive, by start and then kind.

    Null and empty texts have no spans; repeated ids are separate rows.  No shuffle.
    """
    import pyarrow as pa

    order = {k: i for i, k in enumerate([*KINDS, METHOD_KIND])}
    slim = docs.select(column(docs, id_col).alias("doc_id"), F.coalesce(column(docs, text_col), F.lit("")).alias("text"))
    id_type = slim.schema["doc_id"].dataType.simpleString()
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for part in text_slices(batch):
                spans = []
                for text in part.column("text").to_pylist():
                    found = base_spans(text) + random_spans(text, vocabulary, max_chars_per_token)
                    found.sort(key=lambda s: (s[0], order[s[2]]))
                    spans.append([{"kind": k, "start": a, "end": b} for a, b, k in found])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(spans, span_type)], names=["doc_id", "spans"])

    return slim.mapInArrow(run, f"doc_id {id_type}, spans array<struct<kind: string, start: long, end: long>>")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(kind: str) -> Column:
    return F.filter("spans", lambda s: s["kind"] == kind)


def op6_secret_scan(spark, sf_dir) -> DataFrame:
    """Secrets of all documents."""
    import public_tokenizers

    found = scan_secrets(documents(spark, sf_dir), public_tokenizers.path(QUERY_VOCABULARY))
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    base = F.filter("spans", lambda s: s["kind"] != METHOD_KIND)
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
