"""Command line: ``python -m tallyspark ...`` or ``spark-submit --py-files tallyspark.zip tallyspark/__main__.py ...``.

kpi      build the KPI mart from a transactions table and publish it by external id
audit    run the load audit from a scheduler parameter block (JSON) and append its rows
extract  copy a table (parallel JDBC ranges, or files) into the landing folder's partition for a day

The session comes from ``SparkSession.builder.getOrCreate()``, so cluster
settings given to spark-submit apply unchanged.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

from tallyspark.operators.audit import load_status
from tallyspark.plans.kpi_job import KpiJobSettings, run_kpi_job
from tallyspark.plans.lifestyle_spec import LIFESTYLE_SPEC
from tallyspark.plans.load_audit_config import LoadAuditConfig, run_load_audit, unset
from tallyspark.plans.spec import KpiSpec
from tallyspark.sources.export import export_sql, jdbc_extract
from tallyspark.sources.sinks import append_audit, extract_to_landing
from tallyspark.sources.staging import release_staged


def _read(spark, path: str, fmt: str):
    return spark.read.parquet(path) if fmt == "parquet" else spark.read.format(fmt).load(path)


def _opt(value):
    return None if unset(value) else value


def run_kpi(spark: SparkSession, args) -> dict:
    spec = LIFESTYLE_SPEC
    if args.spec:
        with open(args.spec) as fh:
            spec = KpiSpec.from_dict(json.load(fh))
    settings = KpiJobSettings(country=_opt(args.country), bu=_opt(args.bu), source_system=_opt(args.source_system),
                              org_code=_opt(args.org_code), as_of=args.as_of, money=args.money, stage=args.stage)
    return run_kpi_job(_read(spark, args.transactions, args.format), _read(spark, args.external_ids, args.format),
                       spec, settings, args.out, args.published, args.profile)


def run_audit(spark: SparkSession, args) -> dict:
    with open(args.config) as fh:
        cfg = LoadAuditConfig.from_json(fh.read(), args.dag)
    for item in args.table or []:
        name, path = item.split("=", 1)
        _read(spark, path, args.format).createOrReplaceTempView(name)
    status = args.status or load_status(not args.upstream_failed)
    out = run_load_audit(spark, cfg, status, args.start_ts, args.end_ts, args.run_date, args.epoch_time,
                         old_status="failed" if args.upstream_failed else "success")
    append_audit(out["audit_rows"], args.audit_path, run_id=args.run_id, run_date=args.run_date)
    if args.audit_old_path and "table_count_audit" in out:
        append_audit(out["table_count_audit"], args.audit_old_path, partition_by=("load_date",), run_id=args.run_id,
                     run_date=args.run_date)
    if args.summary_path and "audit_summary" in out:
        out["audit_summary"].write.mode("overwrite").parquet(args.summary_path)
    if "table_count_mismatch" in out:
        print(out["table_count_mismatch"], file=sys.stderr)
    return out


def run_extract(spark: SparkSession, args) -> str:
    if args.jdbc_url:
        props = {"user": args.user or "", "password": os.environ.get(args.password_env, "") if args.password_env else ""}
        df = jdbc_extract(spark, args.jdbc_url, args.table, args.partition_column, args.lower_bound,
                          args.upper_bound, args.num_partitions, props)
    else:
        df = _read(spark, args.source_path, args.format)
    query = args.query
    if args.sql_file:
        with open(args.sql_file) as fh:
            query = fh.read()
    if query:
        named = dict(item.split("=", 1) for item in args.named_table or [])
        df = export_sql(spark, query, source=df, **{n: _read(spark, p, args.format) for n, p in named.items()})
    return extract_to_landing(df, args.landing, args.run_date)


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tallyspark")
    sub = p.add_subparsers(dest="command", required=True)
    k = sub.add_parser("kpi", help="KPI mart and its external-id publication")
    k.add_argument("--transactions", required=True)
    k.add_argument("--external-ids", required=True)
    k.add_argument("--out", required=True, help="where the mart is written (overwrite)")
    k.add_argument("--published", help="where the published rows are written (overwrite)")
    k.add_argument("--profile", help="where the non-null profile is written (overwrite)")
    k.add_argument("--spec", help="JSON specification (KpiSpec.to_dict form); default: the 88 lifestyle KPIs")
    k.add_argument("--country", default="KSA")
    k.add_argument("--bu", default="fsn_new")
    k.add_argument("--source-system", default="971002")
    k.add_argument("--org-code", default="FSN")
    k.add_argument("--as-of", default=None, help="yyyy-MM-dd; default current_date()")
    k.add_argument("--money", choices=("double", "cents"), default="double")
    k.add_argument("--stage", action="store_true", help="stage the business-unit rows first")
    k.add_argument("--format", default="parquet")
    a = sub.add_parser("audit", help="load audit from a scheduler parameter block")
    a.add_argument("--config", required=True)
    a.add_argument("--dag", required=True)
    a.add_argument("--table", action="append", help="name=path, registered as a view for the config's SQL")
    a.add_argument("--status", help="status word; default from --upstream-failed")
    a.add_argument("--upstream-failed", action="store_true")
    a.add_argument("--start-ts")
    a.add_argument("--end-ts")
    a.add_argument("--run-date")
    a.add_argument("--audit-path", required=True)
    a.add_argument("--audit-old-path")
    a.add_argument("--summary-path", help="where the run summary is written (overwrite)")
    a.add_argument("--epoch-time", type=int, help="the run's epoch seconds, stored in the per-table audit")
    a.add_argument("--run-id", help="the scheduler's run id: a retried run appends nothing twice")
    a.add_argument("--format", default="parquet")
    e = sub.add_parser("extract", help="copy a table into the landing folder for one run date")
    src = e.add_mutually_exclusive_group(required=True)
    src.add_argument("--jdbc-url")
    src.add_argument("--source-path")
    e.add_argument("--table", help="JDBC table (or a subquery in parentheses)")
    e.add_argument("--partition-column")
    e.add_argument("--lower-bound", type=int, default=0)
    e.add_argument("--upper-bound", type=int, default=0)
    e.add_argument("--num-partitions", type=int, default=1)
    e.add_argument("--user")
    e.add_argument("--password-env", help="name of the environment variable holding the password")
    e.add_argument("--sql-file", help="file with the SQL text, used like --query")
    e.add_argument("--query", help="SQL over {source} applied before landing")
    e.add_argument("--named-table", action="append", help="name=path, a further table {name} of the SQL text")
    e.add_argument("--landing", required=True)
    e.add_argument("--run-date", required=True)
    e.add_argument("--format", default="parquet")
    return p


def main(argv=None) -> dict:
    args = build_parser().parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if args.command == "kpi":
        return run_kpi(spark, args)
    if args.command == "extract":
        return {"landing": run_extract(spark, args)}
    try:
        return run_audit(spark, args)
    finally:
        release_staged(spark)  # everything is written by now


if __name__ == "__main__":
    main(sys.argv[1:])
