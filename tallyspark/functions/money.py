"""Exact money arithmetic in integer cents.

Amounts arrive as doubles with two decimals.  Averages of doubles sit on
``.005`` ties often enough that two engines round them differently, so the
checked forms of the KPIs carry money as integer cents: sums stay exact and an
average is rounded half away from zero with integer arithmetic only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_cents(amount: Column) -> Column:
    """Amount as a bigint number of cents (nearest integer of ``amount * 100``).

    ``rint`` is a plain floating-point operation (``round`` goes through a
    decimal per value).  For amounts with two decimals ``amount * 100`` is within
    a rounding error of an integer, so the result is exact; only an amount with
    an exact half cent would round to even.  Decimals stay decimals throughout, so
    large ones lose no digits (half cents round away from zero).
    """
    exact = F.round(amount * F.lit(100)).cast("bigint")
    return (F.when(F.typeof(amount).startswith("decimal"), exact)  # a constant: one branch remains in the plan
            .otherwise(F.rint(amount * F.lit(100)).cast("bigint")))


def half_up_avg_cents_sql(sum_cents: str, n: str) -> str:
    """SQL text: ``sum_cents / n`` rounded half away from zero; NULL when ``n`` is 0 or NULL.

    Arguments are SQL expressions (typically aggregates); only integer
    arithmetic is used, so the result is exact.
    """
    return (f"CASE WHEN {n} > 0 THEN CAST(signum({sum_cents}) AS BIGINT) * "
            f"((abs({sum_cents}) * 2 + {n}) DIV ({n} * 2)) END")
