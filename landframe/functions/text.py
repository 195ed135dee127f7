"""Text functions (column -> column), all native Catalyst expressions.

Each function states where Spark's nearest built-in differs from what the jobs need
(lpad truncates, trim keeps tabs, concat turns null into null, ...).
"""

from __future__ import annotations

import re

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from landframe.functions._util import as_col

# Fixed value: the characters base R's trimws() removes by default ("[\t\r\n ]").
TRIM_CHARS_CLASS = "[ \\t\\r\\n]"


def pad_left(c, width: int = 12, pad: str = "0") -> Column:
    """Left-pad to ``width`` with ``pad`` and never shorten (Spark's lpad truncates)."""
    c = as_col(c)
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, pad))


def replace_first(c, old: str, new: str) -> Column:
    """Replace the first literal occurrence of ``old`` (no regex)."""
    c = as_col(c)
    pos = F.locate(old, c)
    head = c.substr(F.lit(1), pos - 1)
    tail = c.substr(pos + len(old), F.length(c) + 1)
    return F.when(pos > 0, F.concat(head, F.lit(new), tail)).otherwise(c)


def replace_all(c, old: str, new: str, regex: bool = False) -> Column:
    """Replace every occurrence, literally (default) or as a Java regex."""
    c = as_col(c)
    if regex:
        return F.regexp_replace(c, old, new)
    return F.replace(c, F.lit(old), F.lit(new))


def recode(c, steps: Sequence[tuple[str, str]], regex: bool = True) -> Column:
    """C4: apply replacements one after another, each on the previous result.

    Sequential on purpose: a category text may contain an earlier pattern, and the
    jobs depend on the order the replacements are applied.
    """
    out = as_col(c)
    for pattern, value in steps:
        out = replace_all(out, pattern, value, regex=regex)
    return out


def substring_range(c, start: int, stop: int) -> Column:
    """Characters ``start..stop`` (1-based, inclusive), like R's substr."""
    return F.substring(as_col(c), start, stop - start + 1)


def regroup(c, cuts: Sequence[tuple[int, int]], sep: str = " ") -> Column:
    """Rebuild a code from 1-based inclusive pieces joined by ``sep`` (phone 4+7)."""
    return paste(*[substring_range(c, a, b) for a, b in cuts], sep=sep)


def paste(*cols, sep: str = " ", na_text: str | None = "NA") -> Column:
    """Join values with ``sep``.

    ``na_text="NA"`` reproduces R's paste (a missing value becomes the text ``NA``);
    ``na_text=None`` gives SQL concat semantics (any null makes the result null).
    """
    parts = [as_col(x).cast("string") for x in cols]
    if na_text is not None:
        parts = [F.coalesce(p, F.lit(na_text)) for p in parts]
    return F.concat_ws(sep, *parts) if na_text is not None else _concat_sep(parts, sep)


def _concat_sep(parts: list[Column], sep: str) -> Column:
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(p)
    return F.concat(*pieces)


def trim_ws(c) -> Column:
    """Remove spaces, tabs, CR and LF at both ends (Spark ``trim`` removes spaces only)."""
    return F.regexp_replace(as_col(c), f"^{TRIM_CHARS_CLASS}+|{TRIM_CHARS_CLASS}+$", "")


def compact_key(c) -> Column:
    """Upper case with every space removed (postcode matching key)."""
    return F.replace(F.upper(as_col(c)), F.lit(" "), F.lit(""))


def contains_any(c, words: Iterable[str]) -> Column:
    """True when the text contains any of ``words`` (literal substrings)."""
    c = as_col(c)
    cond = None
    for w in words:
        t = F.contains(c, F.lit(w))
        cond = t if cond is None else (cond | t)
    return F.coalesce(cond, F.lit(False)) if cond is not None else F.lit(False)


def split_clean(c, pattern: str = "[\\r\\n\\t]", dash_to: str | None = "_") -> Column:
    """Split text on a separator regex, remove all spaces from each piece, drop empty
    pieces, map ``-`` to ``dash_to``.

    Written without lambdas so it stays inside whole-stage code generation: spaces are
    removed and ``-`` mapped on the whole text, one split on runs of separators (so blank
    pieces vanish), ``array_remove`` for an empty first or last piece.  If the separator
    pattern could itself match a space or ``-`` the piece-wise form is used instead.
    """
    text = as_col(c)
    if re.fullmatch(pattern, " ") or (dash_to is not None and re.fullmatch(pattern, "-")):
        parts = F.filter(F.transform(F.split(text, pattern), lambda x: F.replace(x, F.lit(" "), F.lit(""))), lambda x: x != F.lit(""))
        return F.transform(parts, lambda x: F.translate(x, "-", dash_to)) if dash_to is not None else parts
    text = F.replace(text, F.lit(" "), F.lit(""))
    if dash_to is not None:
        text = F.translate(text, "-", dash_to)
    return F.array_remove(F.split(text, f"(?:{pattern})+"), F.lit(""))


def strip_prefix(c, prefix: str) -> Column:
    """Remove every occurrence of a literal key prefix (as the jobs' gsub did)."""
    return F.replace(as_col(c), F.lit(prefix), F.lit(""))


def add_prefix(c, prefix: str) -> Column:
    """Put a literal prefix in front of the key."""
    return F.concat(F.lit(prefix), as_col(c))
