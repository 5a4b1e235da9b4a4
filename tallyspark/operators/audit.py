"""Audit rows of a load run, the older per-table audit and the run summary.

All three are built as DataFrames and written in one append, instead of one
``INSERT`` per date.  Run metadata (status, start/end text, run date, epoch)
are inputs; when left out they come from the session clock.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import columns as C
from tallyspark.functions.audit_text import audit_ts_text, row_hash
from tallyspark.functions.frames import first_column
from tallyspark.operators.reconcile import SOURCE_COUNT, TARGET_COUNT

SUCCEEDED = "Succeeded"
FAILED = "failed"


def load_status(upstream_ok: bool) -> str:
    """Status word of the load audit for the upstream extract's outcome."""
    return SUCCEEDED if upstream_ok else FAILED


def _failed(status: str) -> bool:
    return str(status).strip().lower() == FAILED


def _text_ts(value) -> Column:
    if value is None:
        return audit_ts_text(F.current_timestamp())
    if isinstance(value, _dt.datetime):
        return audit_ts_text(F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"))
    return F.lit(str(value))


def _date(value) -> Column:
    if value is None:
        return F.current_date()
    if isinstance(value, (_dt.date, _dt.datetime)):
        value = value.strftime("%Y-%m-%d")
    return F.to_date(F.lit(str(value)))


def audit_rows(recon: DataFrame, dag_name: str, source_tables, target_table: str, status: str,
               start_ts=None, end_ts=None, run_date=None) -> DataFrame:
    """Audit rows in the audit table's column order (``columns.AUDIT_COLUMNS``).

    * one row per reconciled date; a ``failed`` run records target count 0;
    * no increments: exactly one row with both counts 0 and a NULL date;
    * ``hash``: SHA-256 of dag, tables, status, timestamps, counts and both dates,
      so the same run gives the same hash.

    ``recon`` is read twice (rows and marker): hand in a stored one, as it has one row per date.
    """
    if not isinstance(source_tables, str):
        source_tables = ",".join(source_tables)
    rows = recon.select(C.INC_DATE, SOURCE_COUNT, TARGET_COUNT)
    # the no-increment marker: one row exactly when ``recon`` is empty.  A global
    # count of the dates (one row whatever the input), filtered on zero: no join,
    # no subquery; the per-date count joins are pruned from this branch because
    # only the (unique) dates are read.
    marker = rows.select(C.INC_DATE).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == 0).select(
        F.lit(None).cast("date").alias(C.INC_DATE),
        F.lit(0).cast("bigint").alias(SOURCE_COUNT),
        F.lit(0).cast("bigint").alias(TARGET_COUNT))
    tgt = F.lit(0).cast("bigint") if _failed(status) else F.col(TARGET_COUNT).cast("bigint")
    base = rows.unionByName(marker).select(
        F.lit(dag_name).alias("dag_name"),
        F.lit(source_tables).alias("source_tables"),
        F.lit(target_table).alias("target_table"),
        F.lit(status).alias("status"),
        _text_ts(start_ts).alias("start_ts"),
        _text_ts(end_ts).alias("end_ts"),
        F.col(SOURCE_COUNT).cast("bigint").alias("source_count"),
        tgt.alias("target_count"),
        F.col(C.INC_DATE).alias("trx_date"),
        _date(run_date).alias("run_date"),
    )
    hashed = row_hash(*[F.col(c) for c in ("dag_name", "source_tables", "target_table", "status", "start_ts",
                                          "end_ts", "source_count", "target_count", "trx_date", "run_date")])
    return base.select(hashed.alias("hash"), *[c for c in C.AUDIT_COLUMNS if c != "hash"])


@dataclass(frozen=True)
class CountSource:
    """One table of the per-table audit.

    ``frame`` is the table as its count query sees it (filters applied) and is
    counted; with ``frame_is_count=True`` it is already a count query result
    whose first column is the count.  ``load_date`` is an optional SQL
    expression for that table's load date (e.g. ``"current_date()"``).
    """

    table_name: str
    type: str
    frame: DataFrame
    frame_is_count: bool = False
    load_date: str | None = None


def given_count(spark: SparkSession, table_name: str, type: str, count: int, load_date: str | None = None) -> CountSource:
    """A table whose rows were counted already, e.g. while it was written (``sources.sinks.land_and_count``)."""
    frame = spark.range(1).select(F.lit(int(count)).cast("bigint").alias("count"))
    return CountSource(table_name, type, frame, True, load_date)


def _as_source(entry) -> CountSource:
    return entry if isinstance(entry, CountSource) else CountSource(*entry)


def _table_counts(tables, load_date=None) -> DataFrame:
    """``(table_name, type, count, load_date)``, one global count (or given count) per table."""
    frames = []
    for src in map(_as_source, tables):
        if src.frame_is_count:
            counted = first_column(src.frame, "count").select(F.col("count").cast("bigint").alias("count"))
        else:
            counted = src.frame.agg(F.count(F.lit(1)).alias("count"))
        day = F.expr(src.load_date).cast("date") if src.load_date else _date(load_date)
        frames.append(counted.select(F.lit(src.table_name).alias("table_name"), F.lit(src.type).alias("type"),
                                     F.col("count"), day.alias("load_date")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def table_count_audit(tables, dag_name: str, status: str, load_date=None, epoch_time=None) -> DataFrame:
    """Older per-table audit: ``(dag_name, table_name, type, load_date, count, status, epoch_time)``.

    ``tables`` is a list of ``CountSource`` or ``(table_name, type, DataFrame)``
    triples; each DataFrame is the table as the count query sees it.
    """
    epoch = F.unix_timestamp() if epoch_time is None else F.lit(int(epoch_time))
    return _table_counts(tables, load_date).select(
        F.lit(dag_name).alias("dag_name"), "table_name", "type", "load_date",
        F.col("count").cast("bigint").alias("count"), F.lit(status).alias("status"),
        epoch.cast("bigint").alias("epoch_time"))


def audit_summary(tables, dag_name: str, status: str, run_date=None) -> DataFrame:
    """Run summary, one row per table: ``(table_name, count, dag_name, status, type, load_date)``.

    A failed run reports 0 for every table of type ``tgt``.
    """
    count = F.col("count").cast("bigint")
    if _failed(status):
        count = F.when(F.col("type") == F.lit("tgt"), F.lit(0).cast("bigint")).otherwise(count)
    return _table_counts(tables, run_date).select(
        "table_name", count.alias("count"), F.lit(dag_name).alias("dag_name"), F.lit(status).alias("status"),
        "type", _date(run_date).alias("load_date"))
