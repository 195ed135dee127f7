"""Predicates and filters (F1-F8).

Filters stay declarative so Catalyst pushes them into the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landframe.functions._util import as_col, qcol
from landframe.functions.text import contains_any

# Fixed value: the UK postcode pattern the planning job used, verbatim. Only the first
# alternative carries ``^`` and only the second carries ``$``, so a prefixed
# ``'xx SE1 2AA'`` or a suffixed ``'GIR 0AAzz'`` still matches (``strict=False``).
POSTCODE_PATTERN = (
    "^([Gg][Ii][Rr] 0[Aa]{2})|((([A-Za-z][0-9]{1,2})|(([A-Za-z][A-Ha-hJ-Yj-y][0-9]{1,2})|"
    "(([A-Za-z][0-9][A-Za-z])|([A-Za-z][A-Ha-hJ-Yj-y][0-9]?[A-Za-z])))) [0-9][A-Za-z]{2})$"
)
# The same alternatives with both ends anchored for every alternative.
POSTCODE_PATTERN_STRICT = "^(?:" + POSTCODE_PATTERN[1:-1] + ")$"


def valid_postcode(c, strict: bool = False) -> Column:
    """postcode validity (null text -> false)."""
    pattern = POSTCODE_PATTERN_STRICT if strict else POSTCODE_PATTERN
    return F.coalesce(as_col(c).rlike(pattern), F.lit(False))


def keep_contains_any(df: DataFrame, col: str, words: Sequence[str]) -> DataFrame:
    """rows whose text contains any of the words (``TQ`` or ``TL`` tiles)."""
    return df.filter(contains_any(col, words))


def keep_min_length(df: DataFrame, col: str, min_len: int) -> DataFrame:
    """Rows whose text is longer than ``min_len`` (null text dropped)."""
    return df.filter(F.length(qcol(col)) > min_len)


def keep_non_empty(df: DataFrame, col: str) -> DataFrame:
    """rows with non-null, non-empty text."""
    return df.filter(qcol(col).isNotNull() & (qcol(col) != ""))


def slice_rows(df: DataFrame, lo: int, hi: int, order_by: Sequence) -> DataFrame:
    """rows ``lo..hi`` (1-based, inclusive) of the frame sorted by ``order_by``.

    The positional slice is the feature here: a global sort followed by offset/limit,
    which Spark runs as a top-k (``TakeOrderedAndProject``) when ``hi`` is small.
    """
    return df.orderBy(*order_by).offset(lo - 1).limit(hi - lo + 1)


def profile(df: DataFrame, n: int = 6) -> dict:
    """F8: first ``n`` rows, row count and column types (an inspection action)."""
    return {"head": df.limit(n).collect(), "rows": df.count(), "dtypes": df.dtypes}


def profile_table(df: DataFrame) -> DataFrame:
    """F8 as a table: a row per column with its ``position`` (from 1), ``column``, ``dtype``, the
    frame's ``n_rows`` and the column's ``n_missing`` and ``n_distinct`` (non-null values).

    Distinct values are counted per column from one pass of map-side combined (column, value)
    counts, so no column's values are gathered and no row is multiplied by a distinct expand."""
    names = df.columns
    values = F.array(*[F.struct(F.lit(i).alias("position"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(names)])
    counts = df.select(F.explode(values).alias("v")).groupBy("v.position", "v.value").agg(F.count(F.lit(1)).alias("n"))
    per = counts.groupBy("position").agg(
        F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_missing"),
        F.count("value").alias("n_distinct"))
    at = F.col("position") + 1
    return per.select(at.alias("position"), F.element_at(F.array(*map(F.lit, names)), at).alias("column"),
                      F.element_at(F.array(*[F.lit(t) for _, t in df.dtypes]), at).alias("dtype"), "n_rows", "n_missing", "n_distinct")
