from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name (taken literally, dots included) or a Column."""
    return c if isinstance(c, Column) else F.col(f"`{c}`")


def qcol(name: str) -> Column:
    """A top-level column by its exact name (dots and spaces are part of the name)."""
    return F.col(f"`{name}`")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: a plain nested expression would be computed
    anew wherever it is written, inside a lambda for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
