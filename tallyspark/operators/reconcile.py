"""Load reconciliation: source and target row counts for every increment date.

Each side is counted in one grouped aggregate over all dates (never one query
per date); the increments are then left-joined with the two per-date counts,
so the shuffles carry one row per date and task.  Which count a side uses:

1. a row filter is given: rows of that date that satisfy the filter;
2. else a custom count is given (a one-row query): that number for every date;
3. else rows of that date.

Dates without rows get 0.

``prune_to_range=True`` first restricts both sides to the increments' date
range (one scalar subquery).  Use it when the increments are a small set from
a query (e.g. only today): on a source partitioned by the date the range is a
runtime partition filter, so only those partitions are read.  When the
increments are the source's own distinct dates the range covers everything,
so leave it off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark import columns as C
from tallyspark.functions.frames import first_column

SOURCE_COUNT = "source_count"
TARGET_COUNT = "target_count"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _predicate(p) -> Column:
    if isinstance(p, Column):
        return p
    text = p.strip()
    if text[:4].lower() == "and ":  # a filter written to follow "WHERE date = ..."
        text = text[4:]
    return F.expr(text)


def daily_counts(df: DataFrame, date_column, predicate=None, name: str = "n", date_range=None) -> DataFrame:
    """``(trx_date, name)``: rows per date, optionally of the rows that satisfy ``predicate``.

    ``date_range``: a struct column ``{lo, hi}`` (e.g. a scalar subquery) the dates must lie in.
    """
    if predicate is not None:
        df = df.where(_predicate(predicate))
    day = _as_col(date_column).cast("date")
    if date_range is not None:
        df = df.where(day.between(date_range.getField("lo"), date_range.getField("hi")))
    return df.groupBy(day.alias(C.INC_DATE)).agg(F.count(F.lit(1)).alias(name))


def _side(df: DataFrame, date_column, predicate, custom_count, name: str, date_range=None):
    """(per-date counts or None, the count column to project)."""
    if predicate is not None or custom_count is None:
        counts = daily_counts(df, date_column, predicate, name, date_range)
        return counts, F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)
    total = first_column(custom_count, "_n").select(F.col("_n").cast("bigint")).scalar()
    return None, F.coalesce(total, F.lit(0)).cast("bigint").alias(name)


def reconcile(increments: DataFrame, source: DataFrame, target: DataFrame, source_column, target_column,
              source_filter=None, target_filter=None, source_count: DataFrame | None = None,
              target_count: DataFrame | None = None, prune_to_range: bool = False,
              target_counts: DataFrame | None = None) -> DataFrame:
    """``(trx_date, source_count, target_count)``, one row per increment date.

    ``source_filter`` / ``target_filter``: a Column or SQL predicate text (a
    leading ``AND`` is accepted).  ``source_count`` / ``target_count``: a
    one-row DataFrame whose first column is the count, used for every date.
    ``target_counts``: the target's rows per date, ``(trx_date, n)``, if they are known already.
    """
    out = increments.select(F.col(C.INC_DATE).cast("date").alias(C.INC_DATE))
    rng = None
    if prune_to_range:
        rng = out.agg(F.struct(F.min(C.INC_DATE).alias("lo"), F.max(C.INC_DATE).alias("hi"))).scalar()
    s_counts, s_col = _side(source, source_column, source_filter, source_count, SOURCE_COUNT, rng)
    t_counts, t_col = _side(target, target_column, target_filter, target_count, TARGET_COUNT, rng)
    if target_counts is not None:
        t_counts = target_counts.select(C.INC_DATE, F.col("n").alias(TARGET_COUNT))
    for counts in (s_counts, t_counts):
        if counts is not None:
            out = out.join(counts, C.INC_DATE, "left")
    return out.select(C.INC_DATE, s_col, t_col)


def reconcile_counts(increments: DataFrame, source_counts: DataFrame, target_counts: DataFrame) -> DataFrame:
    """``reconcile`` from per-date counts that are there already, such as a count ledger's (``(trx_date, n)`` each)."""
    out = increments.select(F.col(C.INC_DATE).cast("date").alias(C.INC_DATE))
    for counts, name in ((source_counts, SOURCE_COUNT), (target_counts, TARGET_COUNT)):
        out = out.join(counts.select(C.INC_DATE, F.col("n").alias(name)), C.INC_DATE, "left")
    return out.select(C.INC_DATE, *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
                                    for c in (SOURCE_COUNT, TARGET_COUNT)])


def reconcile_source_dates(source: DataFrame, target: DataFrame, source_column, target_column,
                           target_filter=None, target_count: DataFrame | None = None) -> DataFrame:
    """``reconcile`` when the increments are the source's own distinct dates.

    The source's per-date counts already hold exactly those dates (NULL dropped),
    so the source is read once: its counts give both the increments and the
    source column.  Same result as ``reconcile(increment_dates(source, col), ...)``
    without a source filter or a custom source count.
    """
    counts = daily_counts(source, source_column, name=SOURCE_COUNT).where(F.col(C.INC_DATE).isNotNull())
    t_counts, t_col = _side(target, target_column, target_filter, target_count, TARGET_COUNT)
    out = counts
    if t_counts is not None:
        out = out.join(t_counts, C.INC_DATE, "left")
    return out.select(C.INC_DATE, F.col(SOURCE_COUNT).cast("bigint").alias(SOURCE_COUNT), t_col)
