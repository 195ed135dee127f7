"""Aggregations (A1-A6). All are ``groupBy().agg()`` with map-side partial aggregation,
so a key holding a third of the rows is pre-reduced in every task before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landframe.functions._util import as_col, qcol


def poisoned_sum(c) -> Column:
    """``sum`` that is null when any input value is null (R ``sum`` without ``na.rm``)."""
    c = as_col(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def group_sum(df: DataFrame, keys: Sequence[str], col: str, out: str, na: str = "poison") -> DataFrame:
    """A1: one row per key with the sum of ``col``; ``na="poison"`` or ``"skip"``."""
    agg = poisoned_sum(qcol(col)) if na == "poison" else F.sum(qcol(col))
    return df.groupBy(*[qcol(k) for k in keys]).agg(agg.alias(out))


def period_change(df: DataFrame, keys: Sequence[str], period_col: str, p0, p1, value: str,
                  out0: str, out1: str, change: str = "change", na: str = "poison") -> DataFrame:
    """A2: per key, the sum in period ``p0``, the sum in ``p1`` and ``p1 - p0``.

    One conditional-aggregation pass replaces "filter each period, sum, join": only
    keys present in both periods are returned (the inner merge of the two sums).
    """
    pc, v = qcol(period_col), qcol(value)

    def period_sum(p):
        in_p = pc == F.lit(p)
        s = F.sum(F.when(in_p, v))
        if na == "poison":
            s = F.when(F.count(F.when(in_p & v.isNull(), F.lit(1))) == 0, s)
        return s

    g = df.filter(pc.isin(p0, p1)).groupBy(*[qcol(k) for k in keys]).agg(
        period_sum(p0).alias(out0), period_sum(p1).alias(out1),
        F.count(F.when(pc == F.lit(p0), F.lit(1))).alias("__n0"),
        F.count(F.when(pc == F.lit(p1), F.lit(1))).alias("__n1"))
    g = g.filter((F.col("__n0") > 0) & (F.col("__n1") > 0)).drop("__n0", "__n1")
    return g.withColumn(change, qcol(out1) - qcol(out0))


def count_non_null(df: DataFrame, keys: Sequence[str], col: str, out: str) -> DataFrame:
    """A3: number of non-null values (matched rows) per key; ``keys=[]`` for a total."""
    return df.groupBy(*[qcol(k) for k in keys]).agg(F.count(qcol(col)).alias(out))


def multi_occupancy(df: DataFrame, x: str, y: str, area: str, order_by: Sequence[str],
                    count_col: str = "FLAT", total_col: str = "total_flats") -> DataFrame:
    """A4: collapse rows to one per coordinate (x, y) with its row count and the area of
    its first row by ``order_by``; keep coordinates with more than one row; sum the
    counts per area.  Two partial aggregates, no per-row window.
    """
    first_area = F.min(F.struct(*[qcol(c) for c in order_by], qcol(area).alias("__a")))["__a"]
    per_xy = df.groupBy(qcol(x), qcol(y)).agg(F.count(F.lit(1)).alias(count_col), first_area.alias(area))
    return (per_xy.filter(qcol(count_col) > 1).groupBy(qcol(area))
            .agg(F.sum(qcol(count_col)).cast("long").alias(total_col)))


def control_values(df: DataFrame, max_col: str | None = None) -> DataFrame:
    """A5: one row with the row count, whether any row exists (and the maximum of
    ``max_col``)."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), (F.count(F.lit(1)) > 0).alias("has_rows")]
    if max_col:
        aggs.append(F.max(max_col).alias(f"max_{max_col}"))
    return df.agg(*aggs)


def vocabulary(df: DataFrame, col: str, sep: str = " ", min_len: int = 1, out: str = "token") -> DataFrame:
    """Sorted unique tokens of a text column longer than ``min_len`` characters."""
    toks = df.select(F.explode(F.split(qcol(col), sep)).alias(out))
    return toks.filter(F.length(out) > min_len).distinct().orderBy(out)
