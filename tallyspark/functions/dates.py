"""Look-back bounds relative to an anchor date.

``months_back`` subtracts a year-month interval rather than calling
``add_months``: on a timestamp ``add_months`` drops the time of day, while the
interval keeps it.  Both clamp to the last day of a shorter month
(2000-03-31 minus one month is 2000-02-29), the calendar rule of the KPI job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def months_back(anchor: Column, months: int) -> Column:
    """``anchor`` minus ``months`` calendar months, end-of-month clamped, type kept."""
    return anchor - F.make_ym_interval(F.lit(0), F.lit(int(months)))


def days_back(anchor: Column, days: int, is_date: bool = False) -> Column:
    """``anchor`` minus ``days`` days, type kept (``is_date``: the anchor is a DATE)."""
    if is_date:
        return F.date_sub(anchor, int(days))
    return anchor - F.make_dt_interval(F.lit(int(days)))


def month_start_text(anchor: Column) -> Column:
    """First day of the anchor's month as ``yyyy-MM-dd`` text."""
    return F.date_format(F.trunc(F.to_date(anchor), "month"), "yyyy-MM-dd")
