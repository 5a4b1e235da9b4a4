"""Increment discovery: the dates a load run has to process.

``open_dates`` and ``mark_loaded`` keep a state of the dates that earlier runs have loaded,
with the rows that each had then: a run gets the dates that are new and those that
have changed since (late rows, or rows taken back), by one anti join of one row per date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import columns as C
from tallyspark.functions.frames import first_column
from tallyspark.sources.versions import current_version, read_table_version, replace_table

LOADED_COUNT = "loaded_count"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def increment_dates(source: DataFrame, column) -> DataFrame:
    """``(trx_date date)``: the distinct non-NULL values of ``column`` in ``source``.

    A NULL value is dropped (it is not a date to load).  The distinct is a
    grouped aggregate with a map-side partial, so its shuffle carries at most
    one row per date and task.
    """
    d = _as_col(column).cast("date").alias(C.INC_DATE)
    return source.select(d).where(F.col(C.INC_DATE).isNotNull()).distinct()


def increment_dates_sql(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """Increments from a caller's query; its first column is the date.

    ``query`` is run verbatim by ``spark.sql``; ``{name}`` placeholders refer to
    the DataFrames passed as keyword arguments (no global views needed).
    """
    result = spark.sql(query, **frames) if frames else spark.sql(query)
    return increment_dates(first_column(result, C.INC_DATE), C.INC_DATE)


def discover_increments(spark: SparkSession, source: DataFrame, column, query: str | None = None,
                        **frames: DataFrame) -> DataFrame:
    """A caller's query wins; otherwise the distinct dates of the source's incremental column."""
    if query is not None:
        return increment_dates_sql(spark, query, **frames)
    return increment_dates(source, column)


def loaded_dates(spark: SparkSession, state_path: str) -> DataFrame:
    """``(trx_date, loaded_count)`` of every date loaded so far; empty before the first run."""
    if current_version(spark, state_path) is None:
        return spark.createDataFrame([], f"{C.INC_DATE} date, {LOADED_COUNT} bigint")
    return read_table_version(spark, state_path)


def open_dates(source_counts: DataFrame, loaded: DataFrame, count: str = "n", since=None) -> DataFrame:
    """``(trx_date, loaded_count)``: the dates to load now, with the rows that they have now.

    ``source_counts`` is ``(trx_date, <count>)`` of the source (``reconcile.daily_counts``, or a count
    ledger's).  A date is open when it was never loaded, or had another number of rows when it
    was.  A loaded date that has lost all its rows is open too, with none.  ``since``
    (a date) leaves earlier dates closed for good.
    """
    now = source_counts.select(F.col(C.INC_DATE).cast("date").alias(C.INC_DATE),
                               F.col(count).cast("bigint").alias(LOADED_COUNT)).where(F.col(C.INC_DATE).isNotNull())
    gone = (loaded.where(F.col(LOADED_COUNT) > 0).join(now.select(C.INC_DATE), C.INC_DATE, "left_anti")
            .select(C.INC_DATE, F.lit(0).cast("bigint").alias(LOADED_COUNT)))
    out = now.join(loaded, [C.INC_DATE, LOADED_COUNT], "left_anti").unionByName(gone)
    return out if since is None else out.where(F.col(C.INC_DATE) >= F.to_date(F.lit(str(since))))


def mark_loaded(dates: DataFrame, state_path: str) -> None:
    """Add ``(trx_date, loaded_count)`` to the state; a date that is there already gets its new count.

    The state (one row per date) is replaced as a version, so a run that breaks off before
    this leaves its dates open, and one that repeats it changes nothing.
    """
    spark = dates.sparkSession
    before = current_version(spark, state_path)
    new = dates.select(C.INC_DATE, LOADED_COUNT)
    kept = loaded_dates(spark, state_path).join(new.select(C.INC_DATE), C.INC_DATE, "left_anti")
    replace_table(kept.unionByName(new), state_path, based_on=before and before["version"])
