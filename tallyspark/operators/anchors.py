"""Date anchors of a KPI run: the latest date of the set and the look-back bounds derived from it.

The anchor is the maximum date of the rows given (not today).  Bounds keep the
anchor's type: a timestamp anchor gives timestamp bounds with the time of day.
Everything is one global aggregate (partial per task, then one row), so it is
cheap at any scale and never collected: the KPI operator consumes it as a
scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tallyspark import columns as C
from tallyspark.functions.dates import days_back, month_start_text, months_back

DEFAULT_MONTHS = (1, 2, 3, 6, 9, 12, 24)
DEFAULT_DAYS = (1, 7)


def months_col(n: int) -> str:
    return f"months_ago_{n}"


def days_col(n: int) -> str:
    return f"days_ago_{n}"


def date_anchors(rows: DataFrame, date_col: str = C.TRX_DATE, months=DEFAULT_MONTHS,
                 days=DEFAULT_DAYS) -> DataFrame:
    """One row: ``max_date``, ``min_date``, day and month offsets, month/year parts, month start text.

    ``previous_month`` is the month of the anchor minus one month and
    ``previous_year`` the year of the anchor minus twelve months.  On empty
    input every column is NULL.
    """
    mx = F.col("max_date")
    is_date = isinstance(rows.schema[date_col].dataType, DateType)
    agg = rows.agg(F.max(date_col).alias("max_date"), F.min(date_col).alias("min_date"))
    return agg.select(
        "max_date",
        "min_date",
        *[days_back(mx, d, is_date).alias(days_col(d)) for d in days],
        *[months_back(mx, m).alias(months_col(m)) for m in months],
        F.month(mx).alias("current_month"),
        F.year(mx).alias("current_year"),
        F.month(months_back(mx, 1)).alias("previous_month"),
        F.year(months_back(mx, 12)).alias("previous_year"),
        month_start_text(mx).alias("current_month_start_date"),
    )


def window_bounds(rows: DataFrame, months, date_col: str = C.TRX_DATE) -> Column:
    """The look-back bounds as one scalar-subquery struct column ``{months_ago_<n>: bound}``.

    One subquery instead of a join: project it once (as ``kpi_mart`` does) and
    compare dates with its fields, a per-query constant.
    """
    months = sorted(set(months))
    mx = F.max(date_col)
    fields = [months_back(mx, m).alias(months_col(m)) for m in months] or [mx.alias("max_date")]
    return rows.agg(F.struct(*fields).alias("bounds")).scalar()
