"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: fixed by the contracts: words of lower-cased text, as a Java / Python pattern
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: byte table with the same words: A-Z lower-cased, ASCII digits and letters and every
#: byte of a non-ASCII character kept, all other ASCII turned into blanks
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def column(df: DataFrame, name: str) -> Column:
    """A column by its literal name (dots and backticks taken literally)."""
    return df["`" + name.replace("`", "``") + "`"]


def hold(docs: DataFrame, text_col: str) -> DataFrame:
    """``text`` and a struct ``rest`` of all other columns, whose names can clash with nothing
    that an operator adds."""
    others = [column(docs, c).alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text_col]
    return docs.select(F.struct(*(others or [F.lit(True).alias("none")])).alias("rest"), column(docs, text_col).alias("text"))


def release(held: DataFrame, docs: DataFrame, text_col: str, *more: str) -> DataFrame:
    """The columns of ``docs`` again, from a frame with ``text`` and ``rest``, and then ``more``."""
    own = [F.col("text" if c == text_col else f"rest.c{i}").alias(c) for i, c in enumerate(docs.columns)]
    return held.select(*own, *more)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8 bytes (null and empty: none)."""
    return text.encode("utf-8", "replace").translate(_WORD_BYTES).split() if text else []


def by_bytes(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows whose sizes sum to about ``limit`` (one row at least)."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def text_slices(batch, limit: int = 4_000_000):
    """Slices of an Arrow batch whose column ``text`` holds about ``limit`` bytes each, so
    that Python objects are made for a bounded part of the batch at a time."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
    for a, b in by_bytes(sizes, limit):
        yield batch.slice(a, b - a)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
