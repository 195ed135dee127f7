"""Numeric functions. ANSI mode stays on: every conversion that may fail is a ``try_``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landframe.functions._util import as_col


def to_double(c) -> Column:
    """Text -> double, unparsable or empty -> null (R's as.numeric gives NA)."""
    return as_col(c).try_cast("double")


def plain_number(c, scale: int | None = None) -> Column:
    """Render a number without scientific notation (``1.0E12`` -> ``1000000000000``).

    Digits are kept as far as 38 reach: up to 18 after the point from 1 on (none from 1e20
    on), up to 37 below 1, trailing zeros dropped; from 1e38 on the result is null.  ``scale``
    fixes the digits after the point instead."""
    c = as_col(c)
    if scale is not None:
        return c.try_cast(f"decimal(38,{scale})").cast("string")
    small = F.when(F.abs(c.try_cast("double")) < 1, c.try_cast("decimal(38,37)").cast("string"))
    text = F.coalesce(small, c.try_cast("decimal(38,18)").cast("string"), F.concat(c.try_cast("decimal(38,0)").cast("string"), F.lit(".0")))
    return F.regexp_replace(text, "\\.?0+$", "")


def round_half_even(c, digits: int = 0) -> Column:
    """banker's rounding, the closest native match to R's round().

    On doubles Spark rounds the shortest decimal form of the value, so ``1149.17125``
    (printed form) is a tie and goes to ``1149.1712`` even if the binary value lies a
    hair above it.  Round exact decimals when ties matter.
    """
    return F.bround(as_col(c), digits)


def ceil_ratio(c, size: int) -> Column:
    """C14: ceiling of ``c / size`` as a long (batch numbers)."""
    return F.ceil(as_col(c) / F.lit(size)).cast("long")


def safe_ratio(a, b, digits: int | None = 4) -> Column:
    """``a / b`` rounded half-even; null (not an error, not Inf) when ``b`` is 0 or null.

    R returns Inf/NaN for x/0; a null is the SQL way to say "no ratio" and is what the
    oracle produces with ``nullif``.
    """
    r = F.try_divide(as_col(a).try_cast("double"), as_col(b).try_cast("double"))
    return F.bround(r, digits) if digits is not None else r


def difference(a, b) -> Column:
    """``a - b``."""
    return as_col(a) - as_col(b)
