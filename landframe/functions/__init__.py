"""Scalar column functions (C1-C21 and the key helpers used by joins and filters)."""

from landframe.functions.dates import (  # noqa: F401
    format_date, month_label, normalise_date, normalise_datetime, parse_day_month_year)
from landframe.functions.numbers import (  # noqa: F401
    ceil_ratio, difference, plain_number, round_half_even, safe_ratio, to_double)
from landframe.functions.text import (  # noqa: F401
    add_prefix, compact_key, contains_any, pad_left, paste, recode, regroup, replace_all,
    replace_first, split_clean, strip_prefix, substring_range, trim_ws)
