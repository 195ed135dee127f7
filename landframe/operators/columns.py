"""Projection and column operators (P1-P13). All are metadata or per-row expressions."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landframe.functions.dates import month_label


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give every column a new name, in order (headerless V1..Vn -> names)."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def rename_if_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; names that are not in the frame are skipped silently."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def select_at(df: DataFrame, positions: Iterable[int]) -> DataFrame:
    """P5: select by 1-based positions (R's ``df[, c(1, 14:15)]``)."""
    cols = df.columns
    return df.select(*[F.col(f"`{cols[i - 1]}`") for i in positions])


def with_const(df: DataFrame, name: str, value) -> DataFrame:
    """Constant / release-stamp column."""
    return df.withColumn(name, F.lit(value))


def copy_col(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Keep the raw value under a new name before ``src`` is reformatted."""
    return df.withColumn(dst, F.col(f"`{src}`"))


def cast_all(df: DataFrame, cols: Iterable[str], dtype: str = "string") -> DataFrame:
    """P10: cast a set of columns (text is the common target)."""
    return df.withColumns({c: F.col(f"`{c}`").cast(dtype) for c in cols})


def add_null_columns(df: DataFrame, names: Iterable[str], dtype: str = "string") -> DataFrame:
    """Add data-driven all-null columns (names that already exist are left alone)."""
    new = [n for n in names if n not in df.columns]
    return df.select("*", *[F.lit(None).cast(dtype).alias(n) for n in new])


def period_name(as_of: _dt.date) -> str:
    """Upper-case month label of a run date, e.g. ``APR`` (used as a column name)."""
    return as_of.strftime("%b").upper()


def rename_to_period(df: DataFrame, col: str, as_of: _dt.date) -> DataFrame:
    """Rename ``col`` to the month label of ``as_of``."""
    return df.withColumnRenamed(col, period_name(as_of))


def with_month_label(df: DataFrame, date_col: str, out: str) -> DataFrame:
    """P8 as data: the month label computed per row on the executors."""
    return df.withColumn(out, month_label(date_col))
