"""Date parsing and formatting. Unparsable text never raises (ANSI mode stays on)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from landframe.functions._util import as_col

# The input layouts tried, in this order, when a date's layout is not given.
AUTO_DATE_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "yyyyMMddHHmmss",
    "yyyy-MM-dd",
    "yyyyMMdd",
    "yyyy/MM/dd",
    "dd/MM/yyyy",
    "d MMMM yyyy",
    "d MMM yyyy",
)


def parse_day_month_year(c) -> Column:
    """``'3 April 2017'`` -> date; anything else -> null."""
    return F.try_to_date(as_col(c), "d MMMM yyyy")


# Loose shapes of the layouts above (never narrower than what the parser accepts): a
# layout is only tried on text of its shape, so unparsable values cost a regex test
# instead of a failed parse per layout.
_SHAPES = {
    "yyyy-MM-dd'T'HH:mm:ss": r"^\d{4,}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}$",
    "yyyy-MM-dd HH:mm:ss": r"^\d{4,}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$",
    "yyyyMMddHHmmss": r"^\d{14,}$",
    "yyyy-MM-dd": r"^\d{4,}-\d{1,2}-\d{1,2}$",
    "yyyyMMdd": r"^\d{8,}$",
    "yyyy/MM/dd": r"^\d{4,}/\d{1,2}/\d{1,2}$",
    "dd/MM/yyyy": r"^\d{1,2}/\d{1,2}/\d{4,}$",
    "d MMMM yyyy": r"^\d{1,2} \S+ \d{4,}$",
    "d MMM yyyy": r"^\d{1,2} \S+ \d{4,}$",
}


def _auto_timestamp(text: Column, formats: Sequence[str]) -> Column:
    tries = []
    for f in formats:
        parsed = F.try_to_timestamp(text, F.lit(f))
        shape = _SHAPES.get(f)
        tries.append(F.when(text.rlike(shape), parsed) if shape else parsed)
    return F.coalesce(*tries)


def normalise_date(c, out_format: str = "yyyyMMdd",
                   formats: Sequence[str] = AUTO_DATE_FORMATS) -> Column:
    """Recognise a date in any of ``formats`` and re-emit it as ``out_format``.

    The text is trimmed and everything from the first ``.`` on (a millisecond part) is
    ignored before parsing. Values that parse under no format are returned unchanged,
    and empty values stay as they are.
    """
    c = as_col(c)
    text = F.regexp_extract(F.trim(c), "^[^.]*", 0)
    parsed = _auto_timestamp(text, formats)
    return F.when(F.length(text) == 0, c).otherwise(
        F.coalesce(F.date_format(parsed, out_format), c))


def normalise_datetime(c, formats: Sequence[str] = AUTO_DATE_FORMATS) -> Column:
    """C20: as ``normalise_date`` with output ``yyyyMMddHHmmss``."""
    return normalise_date(c, "yyyyMMddHHmmss", formats)


def format_date(c, fmt: str = "yyyyMM") -> Column:
    """Format a date/timestamp (release stamp ``yyyyMM``, ``yyyyMMdd``, ``MMM``)."""
    return F.date_format(as_col(c), fmt)


def month_label(c) -> Column:
    """Upper-case three-letter month name, e.g. ``APR``."""
    return F.upper(F.date_format(as_col(c), "MMM"))
