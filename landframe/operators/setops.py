"""Stacking, distinct and sort."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack(dfs: Sequence[DataFrame]) -> DataFrame:
    """Stack same-schema frames by position (``rbind`` of identical layouts)."""
    return reduce(lambda a, b: a.union(b), dfs)


def stack_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    """Stack frames with the same column set, matched by name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def stack_fill(dfs: Sequence[DataFrame]) -> DataFrame:
    """Stack by name; a column missing from a frame is null there (``bind_rows``)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def distinct_rows(df: DataFrame) -> DataFrame:
    """U4: distinct rows (hash aggregate on all columns, partial map-side)."""
    return df.distinct()


def locale_order(c, collation: str | None) -> Column:
    """A sort key: bytes without ``collation``, else the order of a locale (a Spark collation such
    as ``"UNICODE"`` or ``"en"``: letters before their accents before their case)."""
    return F.col(f"`{c}`") if collation is None else F.collate(F.col(f"`{c}`"), collation)


def unique_sorted(df: DataFrame, col: str, collation: str | None = None) -> DataFrame:
    """Distinct values of one column, sorted ascending by bytes or in a locale's order
    (values stay distinct by their bytes)."""
    key = locale_order(col, collation)
    order = [key.asc_nulls_first()] if collation is None else [key.asc_nulls_first(), F.col(f"`{col}`")]
    return df.select(F.col(f"`{col}`")).distinct().orderBy(*order)


def sort_by(df: DataFrame, cols: Sequence[str], collation: str | None = None) -> DataFrame:
    """Ascending sort: byte order for text, or with ``collation`` a locale's (as R sorts)."""
    text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    return df.orderBy(*(cols if collation is None else [locale_order(c, collation if c in text else None) for c in cols]))
