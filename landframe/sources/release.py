"""Release-gated incremental ingest (S10), batch form."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landframe.functions.dates import parse_day_month_year
from landframe.operators.joins import keep_not_in


def releases_to_ingest(releases: DataFrame, as_of: _dt.date, product: str, done: DataFrame,
                       product_col: str = "product", date_col: str = "update_date",
                       release_col: str = "release") -> DataFrame:
    """Releases of ``product`` whose update date (``'d Month yyyy'`` text) is
    ``as_of`` and that are not already in ``done`` (anti join on the release id)."""
    wanted = releases.filter(F.contains(F.col(product_col), F.lit(product))
                             & (parse_day_month_year(date_col) == F.lit(as_of)))
    return keep_not_in(wanted, done.select(release_col), release_col)
