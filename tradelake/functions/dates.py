"""Calendar helpers for monthly series."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_start(x) -> Column:
    """First day of the month of a date or timestamp, as DATE."""
    return F.trunc(F.to_date(_c(x)), "month")


def last_day_previous_month() -> Column:
    return F.last_day(F.add_months(F.current_date(), -1))
