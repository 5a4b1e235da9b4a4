"""The load audit driven by a job's parameter block, as the scheduler configuration holds it.

The parameter block is JSON.  The text ``"None"`` (any case, surrounding blanks
ignored) means "not set".  Key names are those of the existing configuration
files:

================================  =======================================================
``incerment_query``               query whose first column lists the dates to load
``src_table_or_view``             source table; ``src_incremental_column`` its date column
``filter_on_scr_query``           extra source predicate (``AND ...``), per date
``scr_query``                     source count query, the same for every date
``excel_table``                   target table; ``excel_incremental_column`` its date column
``filter_on_excel_query``         extra target predicate, per date
``excel_query``                   target count query, the same for every date
``source_tables``                 source table names recorded in the audit rows
``dag_audit_src_tbl``             per-table audit: table names ...
``dag_audit_table_type``          ... their types (``src`` / ``tgt``) ...
``dag_audit_src_tbl_count_sql``   ... their count queries ...
``load_date_range``               ... and their load-date expressions
================================  =======================================================

Table names and queries are resolved by ``spark.table`` / ``spark.sql`` in the
session's catalog.  Nothing is collected: the runner writes the reconciliation (one
row per date) to the shared folder and returns DataFrames over it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession

from tallyspark.operators.audit import (CountSource, audit_rows, audit_summary, table_count_audit)
from tallyspark.operators.increments import increment_dates, increment_dates_sql
from tallyspark.operators.reconcile import reconcile, reconcile_source_dates
from tallyspark.sources.staging import stage_table


def unset(value) -> bool:
    """True for None and for the text sentinel ``"None"`` (case and blanks ignored)."""
    return value is None or (isinstance(value, str) and value.strip().lower() == "none")


def _opt(value):
    return None if unset(value) else value


@dataclass(frozen=True)
class CountTable:
    table_name: str
    type: str
    count_query: str
    load_date: str | None = None


@dataclass(frozen=True)
class LoadAuditConfig:
    dag_name: str
    source_tables: tuple
    source: str | None = None
    source_column: str | None = None
    source_filter: str | None = None
    source_count_query: str | None = None
    target: str | None = None
    target_column: str | None = None
    target_filter: str | None = None
    target_count_query: str | None = None
    increment_query: str | None = None
    count_tables: tuple = ()
    #: Why the per-table audit cannot run (its lists do not pair up), or None.
    count_tables_mismatch: str | None = None

    @classmethod
    def from_params(cls, params: dict, dag_name: str) -> "LoadAuditConfig":
        names = list(params.get("dag_audit_src_tbl") or [])
        types = list(params.get("dag_audit_table_type") or [])
        queries = list(params.get("dag_audit_src_tbl_count_sql") or [])
        dates = list(params.get("load_date_range") or [])
        mismatch = None
        if not (len(names) == len(types) == len(queries)) or (dates and len(dates) != len(names)):
            mismatch = ("per-table audit lists differ in length: "
                        f"{len(names)} tables, {len(types)} types, {len(queries)} count queries, "
                        f"{len(dates)} load dates")
        tables = () if mismatch else tuple(CountTable(n, t, q, _opt(dates[i]) if dates else None)
                       for i, (n, t, q) in enumerate(zip(names, types, queries)))
        return cls(
            dag_name=dag_name,
            source_tables=tuple(params.get("source_tables") or ()),
            source=_opt(params.get("src_table_or_view")),
            source_column=_opt(params.get("src_incremental_column")),
            source_filter=_opt(params.get("filter_on_scr_query")),
            source_count_query=_opt(params.get("scr_query")),
            target=_opt(params.get("excel_table")),
            target_column=_opt(params.get("excel_incremental_column")),
            target_filter=_opt(params.get("filter_on_excel_query")),
            target_count_query=_opt(params.get("excel_query")),
            increment_query=_opt(params.get("incerment_query")),
            count_tables=tables,
            count_tables_mismatch=mismatch,
        )

    @classmethod
    def from_json(cls, text: str, dag_name: str) -> "LoadAuditConfig":
        """From a configuration file: ``{"<dag>_config": {"default_args": {"params": {...}}}}``."""
        doc = json.loads(text)
        block = doc.get(f"{dag_name}_config", doc)
        params = block.get("default_args", block).get("params", block)
        return cls.from_params(params, dag_name)


def _side(spark, table, column, filt, count_query, what):
    frame = spark.table(table) if table is not None else None
    needs_rows = filt is not None or count_query is None
    if needs_rows and (frame is None or column is None):
        raise ValueError(f"{what}: a table and its incremental column are needed without a count query")
    count = spark.sql(count_query) if (count_query is not None and filt is None) else None
    return frame, count


def run_load_audit(spark: SparkSession, cfg: LoadAuditConfig, status: str, start_ts=None, end_ts=None,
                   run_date=None, epoch_time=None, old_status: str | None = None) -> dict:
    """All outputs of one load-audit run as DataFrames; the reconciliation (one row per date) is stored when this is called.

    Keys: ``increments``, ``reconciliation``, ``audit_rows``, ``table_count_audit``
    and ``audit_summary`` (the last two only when count tables are configured).  When
    the per-table lists do not pair up, the rest still runs and ``table_count_mismatch``
    holds the reason.
    """
    if cfg.increment_query is not None:
        inc = increment_dates_sql(spark, cfg.increment_query)
    else:
        if cfg.source is None or cfg.source_column is None:
            raise ValueError("increments: set an increment query or a source table and column")
        inc = increment_dates(spark.table(cfg.source), cfg.source_column)
    src, src_count = _side(spark, cfg.source, cfg.source_column, cfg.source_filter, cfg.source_count_query,
                           "source")
    tgt, tgt_count = _side(spark, cfg.target, cfg.target_column, cfg.target_filter, cfg.target_count_query,
                           "target")
    if cfg.increment_query is None and cfg.source_filter is None and src_count is None:
        # the increments are the source's own dates: one pass over the source gives both
        recon = reconcile_source_dates(src, tgt, cfg.source_column, cfg.target_column, cfg.target_filter,
                                       tgt_count)
    else:
        # increments from a query are typically a few days: count only inside their range
        recon = reconcile(inc, src, tgt, cfg.source_column, cfg.target_column, cfg.source_filter,
                          cfg.target_filter, src_count, tgt_count,
                          prune_to_range=cfg.increment_query is not None)
    recon = stage_table(recon, "reconciliation")  # one row per date; the audit rows read it twice
    out = {
        "increments": inc,
        "reconciliation": recon,
        "audit_rows": audit_rows(recon, cfg.dag_name, list(cfg.source_tables), cfg.target or "", status,
                                 start_ts, end_ts, run_date),
    }
    if cfg.count_tables_mismatch:
        out["table_count_mismatch"] = cfg.count_tables_mismatch
    if cfg.count_tables:
        sources = [CountSource(t.table_name, t.type, spark.sql(t.count_query), True, t.load_date)
                   for t in cfg.count_tables]
        out["table_count_audit"] = table_count_audit(sources, cfg.dag_name, old_status or status, None,
                                                     epoch_time)
        out["audit_summary"] = audit_summary(sources, cfg.dag_name, status, run_date)
    return out
