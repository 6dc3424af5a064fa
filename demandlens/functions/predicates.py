"""Row filters shared by the jobs (P3-P11), as Column expressions.

Each is a plain Catalyst expression, so it reaches the scan as a pushed filter where the
source allows it (dates, equality on codes, ``StartsWith`` / ``Contains`` on stores).
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def current(snapshot_col: str | Column, as_of: date) -> Column:
    """Rows of the snapshot taken on ``as_of``."""
    return col(snapshot_col) == F.lit(as_of)


def actualised(snapshot_col: str | Column = "snapshot_date",
               forecast_col: str | Column = "forecast_date") -> Column:
    """Forecast made on its own day (history as it was known)."""
    return col(snapshot_col) == col(forecast_col)


def between(c: str | Column, lo: date, hi: date) -> Column:
    """P5: inclusive date range."""
    return col(c).between(F.lit(lo), F.lit(hi))


def main_line(diag_col: str | Column = "diag_id", null_ok: bool = False) -> Column:
    """Main forecast line ``diag_id = ''``; NULL is rejected unless ``null_ok``."""
    c = col(diag_col)
    return (F.coalesce(c, F.lit("")) if null_ok else c) == F.lit("")


def store_kept(store_col: str | Column = "store", contains: str | None = None,
               ids: Iterable[str] | None = None,
               prefixes: Iterable[str] | None = None) -> Column:
    """Store exclusion by substring, explicit list and/or prefixes.

    As with ``NOT LIKE`` / ``NOT IN``, a NULL store is never kept.
    """
    c = col(store_col)
    cond = c.isNotNull()
    if contains is not None:
        cond = cond & ~c.contains(contains)
    if ids is not None:
        cond = cond & ~c.isin(list(ids))
    for p in prefixes or ():
        cond = cond & ~c.startswith(p)
    return cond


def promo_flag(offer_col: str | Column = "ofr_id") -> Column:
    """1 when the row carries an offer id, else 0 (NULL counts as no offer)."""
    return F.when(col(offer_col) != F.lit(""), F.lit(1)).otherwise(F.lit(0))
