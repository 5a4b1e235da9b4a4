"""The load audit driven by Structured Streaming over the landing folder.

A scheduled run starts the stream with ``trigger(availableNow=True)``: the file
source's checkpoint remembers which landing files were already audited, so each
run sees exactly the files landed since the previous one (increment discovery
without a query over the whole target).  Every micro-batch:

1. takes the distinct dates of its own rows as the increments,
2. counts the source and the landing table per date inside the batch's date range
   only (grouped aggregates; a runtime partition filter on a dated table), and
3. writes the audit rows into ``<audit_path>/batch_id=<n>/`` with overwrite, so
   a replayed batch replaces its own rows instead of duplicating them.

A run with nothing new writes the no-increment marker row.  No ``maxFilesPerTrigger`` is set on purpose: with ``availableNow`` all files
landed since the last run form one batch, so the rows of one landed day are
counted together (a cap could split a day across batches).  A re-extracted day
replaces its landing partition, and its new files are audited in full.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyspark.operators.audit import audit_rows
from tallyspark.operators.count_ledger import ledger_counts, renew_counts
from tallyspark.operators.increments import increment_dates
from tallyspark.operators.reconcile import reconcile
from tallyspark.sources.files import Files


def audit_batch(batch: DataFrame, batch_id: int, date_column: str, source: DataFrame, source_column,
                audit_path: str, dag_name: str, source_tables, target_table: str, status: str,
                start_ts=None, end_ts=None, run_date=None, target: DataFrame | None = None,
                target_counts: DataFrame | None = None) -> None:
    """Audit one micro-batch of landed rows into ``<audit_path>/batch_id=<n>/`` (overwrite: replay-safe)."""
    inc = increment_dates(batch, date_column)
    # the source is counted only inside the batch's date range (partition pruning on a dated source)
    # the target is the landing table: a date landed over several runs is counted in full
    recon = reconcile(inc, source, batch if target is None else target, source_column, date_column,
                      prune_to_range=True, target_counts=target_counts)
    rows = audit_rows(recon, dag_name, source_tables, target_table, status, start_ts, end_ts, run_date)
    rows.write.mode("overwrite").parquet(f"{audit_path}/batch_id={int(batch_id)}")


def audit_landing_stream(spark: SparkSession, landing_path: str, date_column: str, source: DataFrame,
                         source_column, audit_path: str, checkpoint_path: str, dag_name: str,
                         source_tables, target_table: str, status: str, start_ts=None, end_ts=None,
                         run_date=None, schema=None, counts_path: str | None = None) -> None:
    """Audit every landing file not yet audited, then stop (one scheduled run).

    ``counts_path``: a count ledger (``operators.count_ledger``) of the landing folder.  Each run then
    counts only the partitions that have changed and takes the dates' counts from the ledger, instead of
    reading the landing table's history.  A landing folder without files is a run with nothing new.
    """
    ran = []
    if Files(spark, landing_path).files_below(landing_path):
        if schema is None:
            schema = spark.read.parquet(landing_path).schema
        _run_stream(spark, landing_path, date_column, source, source_column, audit_path, checkpoint_path, dag_name,
                    source_tables, target_table, status, start_ts, end_ts, run_date, schema, counts_path, ran)
    if not ran:  # nothing new: the run still leaves its marker row
        nothing = spark.createDataFrame([], "trx_date date, source_count bigint, target_count bigint")
        rows = audit_rows(nothing, dag_name, source_tables, target_table, status, start_ts, end_ts, run_date)
        rows.write.mode("overwrite").parquet(f"{audit_path}/batch_id=none-{uuid.uuid4().hex}")


def _run_stream(spark, landing_path, date_column, source, source_column, audit_path, checkpoint_path, dag_name,
                source_tables, target_table, status, start_ts, end_ts, run_date, schema, counts_path, ran) -> None:
    stream = spark.readStream.schema(schema).option("basePath", landing_path).parquet(landing_path)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        counts = None
        if counts_path is not None:
            renew_counts(spark, landing_path, counts_path, date_column, schema)
            counts = ledger_counts(spark, counts_path)
        landed = spark.read.schema(schema).parquet(landing_path)
        audit_batch(batch, batch_id, date_column, source, source_column, audit_path, dag_name,
                    source_tables, target_table, status, start_ts, end_ts, run_date, landed, counts)
        ran.append(batch_id)

    query = (stream.writeStream.foreachBatch(on_batch)
             .option("checkpointLocation", checkpoint_path)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()


def read_stream_audit(spark: SparkSession, audit_path: str) -> DataFrame:
    """Audit rows written by the stream, without the batch id."""
    df = spark.read.parquet(audit_path)
    return df.drop("batch_id") if "batch_id" in df.columns else df


__all__ = ["audit_batch", "audit_landing_stream", "read_stream_audit"]
