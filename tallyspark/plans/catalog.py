"""The registered queries: library operators wired to the supplied tables.

Every query takes ``(spark, sf_dir)`` and returns a DataFrame (round trips write when called) over the
whole tables of ``sf_dir``.  Parameters that the production jobs take from
their configuration are fixed here once (``SETTINGS``) so every run of a query
is repeatable: the as-of date, the run timestamps and the upstream status are
inputs, never the wall clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators.anchors import date_anchors
from tallyspark.operators.audit import (FAILED, SUCCEEDED, audit_rows, audit_summary, given_count,
                                        table_count_audit)
from tallyspark.operators.business_unit import customer_keys, select_business_unit
from tallyspark.operators.count_ledger import ledger_counts, renew_counts
from tallyspark.operators.increments import discover_increments, loaded_dates, mark_loaded, open_dates
from tallyspark.operators.kpi import kpi_mart
from tallyspark.operators.kpi_state import advance_mart, rows_since, state_as_of
from tallyspark.operators.publish import external_pairs, publish_external
from tallyspark.operators.quality import non_null_profile, round_floats
from tallyspark.operators.reconcile import daily_counts, reconcile, reconcile_counts, reconcile_source_dates
from tallyspark.plans.kpi_job import KpiJobSettings, run_kpi_job
from tallyspark.plans.lifestyle_spec import supplied_tables_spec
from tallyspark.plans.load_audit_config import LoadAuditConfig, run_load_audit
from tallyspark.plans.spec import ACTIVE, COUNT, INACTIVE, SUM
from tallyspark.session import scratch_path
from tallyspark.sources import retail_views as V
from tallyspark.sources.export import balanced_ranges, export_sql, extract_ranges
from tallyspark.sources.sinks import (RUN_DATE, append_audit, extract_to_landing, land_and_count, read_audit, read_kpi,
                                      read_landing, write_kpi)
from tallyspark.sources.staging import stage_table
from tallyspark.sources.versions import replace_table
from tallyspark.streaming.landing_audit import audit_landing_stream, read_stream_audit

# Parameters of the supplied-table runs (the production values live in the job configuration).
SETTINGS = {
    "country": "ASIA",
    "as_of": "2001-06-30",
    "bu": "N",
    "source_system": "O",
    "org_code": "BUILDING",
}

SPEC = supplied_tables_spec()


def _bu_rows(spark: SparkSession, sf_dir: str, with_bu: bool = False, all_regions: bool = False) -> DataFrame:
    trx = V.transactions(spark, sf_dir)
    country = None if all_regions else SETTINGS["country"]
    if with_bu:
        return select_business_unit(trx, country, SETTINGS["bu"], SETTINGS["source_system"],
                                    as_of=SETTINGS["as_of"])
    return select_business_unit(trx, country, as_of=SETTINGS["as_of"])


def q_trx_base(spark, sf_dir):
    return _bu_rows(spark, sf_dir, with_bu=True)


def q_customer_keys(spark, sf_dir):
    return customer_keys(_bu_rows(spark, sf_dir))


def q_date_anchors(spark, sf_dir):
    a = date_anchors(_bu_rows(spark, sf_dir))
    # the supplied order dates are midnights: compare the bounds as dates
    return a.select(*[F.to_date(c).alias(c) if t.startswith("timestamp") else F.col(c) for c, t in a.dtypes])


def _mart(spark, sf_dir, spec, money="cents"):
    # the business-unit set is the result of a six-table join: stage it once (see kpi_mart)
    return kpi_mart(_bu_rows(spark, sf_dir), spec, money=money, stage=True)


def q_kpi_total_spend(spark, sf_dir):
    return _mart(spark, sf_dir, SPEC.select(measures={SUM}))


def q_kpi_avg_spend(spark, sf_dir):
    return _mart(spark, sf_dir, SPEC.select(family_keys={"avg_spend_6m", "avg_spend_3m", "avg_spend_1m",
                                                         "avg_spend_2m"}))


def q_kpi_avg_transaction_value(spark, sf_dir):
    return _mart(spark, sf_dir, SPEC.select(family_keys={"avg_transaction_value_12m"}))


def q_kpi_lifetime_transactions(spark, sf_dir):
    return _mart(spark, sf_dir, SPEC.select(measures={COUNT}))


def q_kpi_activity_flags(spark, sf_dir):
    return _mart(spark, sf_dir, SPEC.select(measures={ACTIVE, INACTIVE}))


def q_kpi_mart(spark, sf_dir):
    return _mart(spark, sf_dir, SPEC)


def q_kpi_mart_all_regions(spark, sf_dir):
    return kpi_mart(_bu_rows(spark, sf_dir, all_regions=True), SPEC, money="cents", stage=True)


def q_kpi_mart_business_unit(spark, sf_dir):
    """The mart over the full business-unit set (region, BU and source system)."""
    return kpi_mart(_bu_rows(spark, sf_dir, with_bu=True), SPEC, money="cents", stage=True)


def q_kpi_rounded(spark, sf_dir):
    return round_floats(_mart(spark, sf_dir, SPEC.select(measures={SUM}), money="double"), 2)


def q_kpi_non_null_profile(spark, sf_dir):
    return non_null_profile(_mart(spark, sf_dir, SPEC))


def q_external_id_map(spark, sf_dir):
    return external_pairs(V.external_id_map(spark, sf_dir), SETTINGS["org_code"])


def q_kpi_published(spark, sf_dir):
    mart = stage_table(_mart(spark, sf_dir, SPEC), "mart")  # read for the rows and for the winners
    return publish_external(mart, V.external_id_map(spark, sf_dir), SETTINGS["org_code"])


def q_kpi_mart_double(spark, sf_dir):
    """The mart in doubles, unrounded, over the quantities (whole numbers, whose sums are exact)."""
    trx = V.transactions(spark, sf_dir, amount="l_quantity")
    bu = select_business_unit(trx, SETTINGS["country"], as_of=SETTINGS["as_of"])
    return kpi_mart(bu, SPEC, money="double", stage=True)


KPI_QUERIES = {
    "trx_base": q_trx_base,
    "customer_keys": q_customer_keys,
    "date_anchors": q_date_anchors,
    "kpi_total_spend": q_kpi_total_spend,
    "kpi_avg_spend": q_kpi_avg_spend,
    "kpi_avg_transaction_value": q_kpi_avg_transaction_value,
    "kpi_lifetime_transactions": q_kpi_lifetime_transactions,
    "kpi_activity_flags": q_kpi_activity_flags,
    "kpi_mart": q_kpi_mart,
    "kpi_mart_all_regions": q_kpi_mart_all_regions,
    "kpi_mart_business_unit": q_kpi_mart_business_unit,
    "kpi_rounded": q_kpi_rounded,
    "kpi_non_null_profile": q_kpi_non_null_profile,
    "external_id_map": q_external_id_map,
    "kpi_published": q_kpi_published,
    "kpi_mart_double": q_kpi_mart_double,
}


# --- load audit -------------------------------------------------------------------------

AUDIT = {
    "dag_name": "events_load",
    "source_tables": ["events"],
    "target_table": "events_loaded",
    "start_ts": "2024-02-01 05:00:00 AM",
    "end_ts": "2024-02-01 05:20:00 AM",
    "run_date": "2024-02-01",
    "epoch_time": 1706763600,
    "source_filter": "AND event_type <> 'view'",
    "target_filter": "value >= 10",
    "source_count_sql": "SELECT count(*) AS n FROM {src} WHERE event_type IN ('click', 'purchase')",
    "target_count_sql": "SELECT count(*) AS n FROM {tgt}",
    "increment_sql": "SELECT CAST(ts AS DATE) AS d FROM {events} WHERE event_type = 'purchase' AND value > 40",
    "no_increment_sql": "SELECT CAST(ts AS DATE) AS d FROM {events} WHERE event_type = 'refund'",
    "latest_day_sql": "SELECT max(CAST(ts AS DATE)) AS d FROM {events}",
}


def _increments(spark, sf_dir, query=None):
    src = V.audit_source(spark, sf_dir)
    if query is None:
        return discover_increments(spark, src, V.EVENT_DATE)
    return discover_increments(spark, src, V.EVENT_DATE, query, events=src)


def _recon(spark, sf_dir, mode="daily", increments_query=None):
    src, tgt = V.audit_source(spark, sf_dir), V.audit_target(spark, sf_dir)
    inc = _increments(spark, sf_dir, increments_query)
    if mode == "filtered":
        return reconcile(inc, src, tgt, V.EVENT_DATE, V.EVENT_DATE,
                         source_filter=AUDIT["source_filter"], target_filter=AUDIT["target_filter"])
    if mode == "custom":
        return reconcile(inc, src, tgt, V.EVENT_DATE, V.EVENT_DATE,
                         source_count=export_sql(spark, AUDIT["source_count_sql"], src=src),
                         target_count=export_sql(spark, AUDIT["target_count_sql"], tgt=tgt))
    return reconcile(inc, src, tgt, V.EVENT_DATE, V.EVENT_DATE)


def _audit(spark, sf_dir, status, increments_query=None, **changed):
    a = AUDIT | changed
    if increments_query is None:  # increments are the source's own dates: one pass over the source
        recon = reconcile_source_dates(V.audit_source(spark, sf_dir), V.audit_target(spark, sf_dir),
                                       V.EVENT_DATE, V.EVENT_DATE)
    else:
        recon = _recon(spark, sf_dir, increments_query=increments_query)
    recon = stage_table(recon, "reconciliation")  # one row per date, read for the rows and for the marker
    return audit_rows(recon, a["dag_name"], a["source_tables"], a["target_table"], status, a["start_ts"],
                      a["end_ts"], a["run_date"])


def _count_tables(spark, sf_dir):
    return [("events", "src", V.active_source(spark, sf_dir)),
            ("events_loaded", "tgt", V.audit_target(spark, sf_dir))]


def q_increment_dates(spark, sf_dir):
    return _increments(spark, sf_dir)


def q_increment_dates_sql(spark, sf_dir):
    return _increments(spark, sf_dir, AUDIT["increment_sql"])


def q_reconcile_daily(spark, sf_dir):
    return _recon(spark, sf_dir, "daily")


def q_reconcile_source_dates(spark, sf_dir):
    """The default reconciliation with the source read once (its counts give the increments)."""
    src, tgt = V.audit_source(spark, sf_dir), V.audit_target(spark, sf_dir)
    return reconcile_source_dates(src, tgt, V.EVENT_DATE, V.EVENT_DATE)


def q_reconcile_filtered(spark, sf_dir):
    return _recon(spark, sf_dir, "filtered")


def q_reconcile_custom(spark, sf_dir):
    return _recon(spark, sf_dir, "custom")


def q_reconcile_latest_day(spark, sf_dir):
    """Only the latest day is loaded: both sides are counted inside the increments' range only."""
    src, tgt = V.audit_source(spark, sf_dir), V.audit_target(spark, sf_dir)
    inc = _increments(spark, sf_dir, AUDIT["latest_day_sql"])
    return reconcile(inc, src, tgt, V.EVENT_DATE, V.EVENT_DATE, target_filter=AUDIT["target_filter"],
                     prune_to_range=True)


def q_audit_rows(spark, sf_dir):
    return _audit(spark, sf_dir, SUCCEEDED)


def q_audit_rows_failed(spark, sf_dir):
    return _audit(spark, sf_dir, FAILED)


def q_audit_rows_empty(spark, sf_dir):
    return _audit(spark, sf_dir, SUCCEEDED, increments_query=AUDIT["no_increment_sql"])


def q_audit_rows_timestamps(spark, sf_dir):
    """Run timestamps given as times, one before noon and one after; the operator writes their text."""
    return _audit(spark, sf_dir, SUCCEEDED, start_ts=dt.datetime(2024, 2, 1, 9, 5, 7),
                  end_ts=dt.datetime(2024, 2, 1, 17, 45, 0))


def q_table_count_audit(spark, sf_dir):
    a = AUDIT
    return table_count_audit(_count_tables(spark, sf_dir), a["dag_name"], "success", a["run_date"],
                             a["epoch_time"])


def q_audit_summary(spark, sf_dir):
    return audit_summary(_count_tables(spark, sf_dir), AUDIT["dag_name"], FAILED, AUDIT["run_date"])


# The same audit driven by a scheduler parameter block ("None" marks an unset value).
CONFIG_VIEWS = ("tallyspark_events", "tallyspark_events_loaded")
CONFIG_PARAMS = {
    "incerment_query": "None",
    "src_table_or_view": CONFIG_VIEWS[0],
    "src_incremental_column": V.EVENT_DATE,
    "filter_on_scr_query": " none ",
    "scr_query": "None",
    "excel_table": CONFIG_VIEWS[1],
    "excel_incremental_column": V.EVENT_DATE,
    "filter_on_excel_query": "AND value >= 10",
    "excel_query": "None",
    "source_tables": ["events"],
    "dag_audit_src_tbl": ["events", "events_loaded"],
    "dag_audit_table_type": ["src", "tgt"],
    "dag_audit_src_tbl_count_sql": [
        f"SELECT count(*) FROM {CONFIG_VIEWS[0]} WHERE event_type NOT IN ('error', 'signup')",
        f"SELECT count(*) FROM {CONFIG_VIEWS[1]}",
    ],
    "load_date_range": ["DATE'2024-02-01'", "DATE'2024-02-01'"],
}


def _config_run(spark, sf_dir, status, params=None):
    V.audit_source(spark, sf_dir).createOrReplaceTempView(CONFIG_VIEWS[0])
    V.audit_target(spark, sf_dir).createOrReplaceTempView(CONFIG_VIEWS[1])
    cfg = LoadAuditConfig.from_params(params or CONFIG_PARAMS, AUDIT["dag_name"])
    a = AUDIT
    return run_load_audit(spark, cfg, status, a["start_ts"], a["end_ts"], a["run_date"], a["epoch_time"],
                          old_status="success")


def q_config_audit_rows(spark, sf_dir):
    return _config_run(spark, sf_dir, SUCCEEDED)["audit_rows"]


def q_config_table_count_audit(spark, sf_dir):
    return _config_run(spark, sf_dir, SUCCEEDED)["table_count_audit"]


def q_config_audit_summary(spark, sf_dir):
    return _config_run(spark, sf_dir, FAILED)["audit_summary"]


# A block whose per-table lists do not pair up (one name, two queries), with an increment query and a fixed count.
SHIPPED_PARAMS = CONFIG_PARAMS | {
    "incerment_query": f"SELECT event_date FROM {CONFIG_VIEWS[0]} WHERE event_type = 'purchase' AND value > 40",
    "scr_query": f"SELECT count(*) FROM {CONFIG_VIEWS[0]} WHERE event_type IN ('click', 'purchase')",
    "filter_on_excel_query": "None",
    "dag_audit_src_tbl": ["events"],
}


def q_config_audit_shipped(spark, sf_dir):
    """Increments, reconciliation and audit rows run although the per-table audit cannot."""
    out = _config_run(spark, sf_dir, SUCCEEDED, SHIPPED_PARAMS)
    if "table_count_mismatch" not in out:
        raise AssertionError("the mismatch must be reported")
    return out["audit_rows"]


AUDIT_QUERIES = {
    "increment_dates": q_increment_dates,
    "increment_dates_sql": q_increment_dates_sql,
    "reconcile_daily": q_reconcile_daily,
    "reconcile_source_dates": q_reconcile_source_dates,
    "reconcile_filtered": q_reconcile_filtered,
    "reconcile_custom": q_reconcile_custom,
    "reconcile_latest_day": q_reconcile_latest_day,
    "audit_rows": q_audit_rows,
    "audit_rows_failed": q_audit_rows_failed,
    "audit_rows_empty": q_audit_rows_empty,
    "audit_rows_timestamps": q_audit_rows_timestamps,
    "table_count_audit": q_table_count_audit,
    "audit_summary": q_audit_summary,
    "config_audit_shipped": q_config_audit_shipped,
    "config_audit_rows": q_config_audit_rows,
    "config_table_count_audit": q_config_table_count_audit,
    "config_audit_summary": q_config_audit_summary,
}


# --- export, landing and sinks (write to a fresh folder under spark.checkpoint.dir, read back) ---

EXPORT_SQL = ("SELECT event_date, event_type, count(*) AS n_events, round(sum(value), 2) AS total_value "
              "FROM {events} GROUP BY event_date, event_type")
LANDING_RUNS = ("2024-02-01", "2024-02-02")


def q_export_sql(spark, sf_dir):
    return export_sql(spark, EXPORT_SQL, events=V.audit_source(spark, sf_dir))


def q_landing_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "landing")
    extract = q_export_sql(spark, sf_dir)
    extract_to_landing(extract.where(F.col("event_type") == F.lit("click")), path, LANDING_RUNS[0])
    extract_to_landing(extract, path, LANDING_RUNS[1])
    extract_to_landing(extract.where(F.lit(False)), path, LANDING_RUNS[0])  # an empty re-run empties day one
    # rows that outlived the empty re-run would show in the result, without a date
    gone = stage_table(read_landing(spark, path, LANDING_RUNS[0]).withColumn(RUN_DATE, F.lit(None).cast("date")), "gone")
    extract_to_landing(extract, path, LANDING_RUNS[0])  # re-run of day one replaces only day one
    return read_landing(spark, path).unionByName(gone)


def q_kpi_overwrite_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "kpi")
    write_kpi(_mart(spark, sf_dir, SPEC.select(measures={SUM})), path)
    write_kpi(_mart(spark, sf_dir, SPEC), path)  # replaces data and schema
    return read_kpi(spark, path)


def q_kpi_overwrite_broken(spark, sf_dir):
    """A write that fails in its last rows, and one that lost a race: the table before them is still read."""
    path = scratch_path(spark, "kpi")
    mart = _mart(spark, sf_dir, SPEC.select(measures={SUM}))
    write_kpi(mart, path)
    broken = read_kpi(spark, path).limit(0).unionByName(mart.where(F.expr("assert_true(false) IS NULL")))
    for attempt in (lambda: write_kpi(broken, path), lambda: replace_table(mart.limit(1), path, based_on="another")):
        try:
            attempt()
        except (PySparkException, RuntimeError):
            continue
        raise AssertionError("the write must not succeed")
    return read_kpi(spark, path)


INCREMENTAL_DAYS = ("2001-06-28", "2001-06-29", "2001-06-30")


def q_kpi_mart_incremental(spark, sf_dir):
    """The mart of three successive days, each from the last day's state and the rows of the new day."""
    state, out = scratch_path(spark, "kpi-state"), None
    trx = V.transactions(spark, sf_dir)
    for day in INCREMENTAL_DAYS:
        bu = select_business_unit(trx, SETTINGS["country"], as_of=day)
        mart = advance_mart(rows_since(bu, state_as_of(spark, state), day), state, SPEC, day)
        mart = stage_table(mart.withColumn("as_of", F.to_date(F.lit(day))), "mart")  # the state moves on
        out = mart if out is None else out.unionByName(mart)
    return out


def q_audit_append_after_older(spark, sf_dir):
    """Rows appended without a run id come first; the retry of the run after them adds nothing."""
    path, day = scratch_path(spark, "audit"), AUDIT["run_date"]
    append_audit(_audit(spark, sf_dir, FAILED), path)
    for end in (AUDIT["end_ts"], "2024-02-01 06:00:00 AM"):
        append_audit(_audit(spark, sf_dir, SUCCEEDED, end_ts=end), path, run_id="run-1", run_date=day)
    return read_audit(spark, path)


def q_reconcile_ledger(spark, sf_dir):
    """Two days of landing, then the first landed anew with its clicks only: the ledger counts what changed."""
    landing, ledger = scratch_path(spark, "landing"), scratch_path(spark, "counts")
    src, tgt = V.audit_source(spark, sf_dir), V.audit_target(spark, sf_dir)
    early = F.col(V.EVENT_DATE) < F.to_date(F.lit("2024-01-16"))
    steps = ((LANDING_RUNS[0], tgt.where(early)), (LANDING_RUNS[1], tgt.where(~early)),
             (LANDING_RUNS[0], tgt.where(early & (F.col("event_type") == F.lit("click")))))
    for run_date, rows in steps:
        extract_to_landing(rows, landing, run_date)
        if renew_counts(spark, landing, ledger, V.EVENT_DATE) != [f"{RUN_DATE}={run_date}"]:
            raise AssertionError("only the landed partition is to be counted")
    return reconcile_counts(_increments(spark, sf_dir), daily_counts(src, V.EVENT_DATE), ledger_counts(spark, ledger))


def q_increment_high_water(spark, sf_dir):
    """Three runs: the days before the 16th but no errors, all days, and a run with errors of two days come late."""
    state, out = scratch_path(spark, "loaded"), None
    src = V.audit_source(spark, sf_dir)
    error = F.col("event_type") == F.lit("error")
    day = F.col(V.EVENT_DATE)
    views = (src.where((day < F.to_date(F.lit("2024-01-16"))) & ~error), src.where(~error),
             src.where(~error | day.isin(F.to_date(F.lit("2024-01-05")), F.to_date(F.lit("2024-01-20")))))
    for run, rows in enumerate(views, 1):
        dates = stage_table(open_dates(daily_counts(rows, V.EVENT_DATE), loaded_dates(spark, state)), "open")
        mark_loaded(dates, state)
        dates = dates.withColumn("run", F.lit(run))
        out = dates if out is None else out.unionByName(dates)
    return out


def q_table_count_audit_observed(spark, sf_dir):
    """The per-table audit from counts taken while the rows were landed; nothing is read a second time."""
    a = AUDIT
    seen = land_and_count(V.audit_source(spark, sf_dir), scratch_path(spark, "landing"), a["run_date"], {
        "active": ~F.col("event_type").isin("error", "signup"), "loaded": F.col("event_type") != F.lit("error")})
    tables = [given_count(spark, "events", "src", seen["active"]),
              given_count(spark, "events_loaded", "tgt", seen["loaded"])]
    return table_count_audit(tables, a["dag_name"], "success", a["run_date"], a["epoch_time"])


EXTRACT_RANGES = 16


def q_extract_balanced(spark, sf_dir):
    """Line items in balanced ranges of a key that is 1 for a third of them: what each status has in all ranges.

    ``balanced`` tells that the largest range has at most twice the mean of rows.
    """
    line = V.read_table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") % 3 == 0, F.lit(1)).otherwise(F.col("l_partkey")).alias("k"), "l_orderkey",
        "l_linestatus", "l_quantity")
    parts = extract_ranges(line, balanced_ranges(line, "k", EXTRACT_RANGES, spread="l_orderkey"))
    sizes = parts.groupBy("extract_range").agg(F.count("*").alias("n"))
    most = sizes.agg((F.max("n") <= 2 * F.sum("n") / EXTRACT_RANGES).alias("balanced")).scalar()
    rows = parts.where(F.col("extract_range").isNotNull()).groupBy("l_linestatus").agg(
        F.count("*").alias("n_rows"), F.sum("l_orderkey").alias("order_keys"), F.sum("l_quantity").alias("quantity"))
    return rows.withColumn("balanced", most)


def q_audit_append_roundtrip(spark, sf_dir):
    """A run, its retry at another time, a failed run, and the first run's texts on another run date."""
    path, day, next_day = scratch_path(spark, "audit"), AUDIT["run_date"], "2024-02-02"
    append_audit(_audit(spark, sf_dir, SUCCEEDED), path, run_id="run-1", run_date=day)
    append_audit(_audit(spark, sf_dir, SUCCEEDED, end_ts="2024-02-01 06:00:00 AM"), path, run_id="run-1",
                 run_date=day)  # a retry: nothing is added
    append_audit(_audit(spark, sf_dir, FAILED), path, run_id="run-2", run_date=day)
    append_audit(_audit(spark, sf_dir, SUCCEEDED, run_date=next_day), path, run_id="run-1", run_date=next_day)
    return read_audit(spark, path, dag_name=AUDIT["dag_name"])


def q_landing_stream_audit(spark, sf_dir):
    """Loaded events land in two runs that share one day; a third run finds nothing new.

    Each run's stream audits the newly landed dates, counted in all that has landed.
    """
    a = AUDIT
    root = scratch_path(spark, "stream")
    landing, audit, ckpt = f"{root}/landing", f"{root}/audit", f"{root}/checkpoint"
    src, tgt = V.audit_source(spark, sf_dir), V.audit_target(spark, sf_dir)
    split = F.to_date(F.lit("2024-01-16"))
    early = (F.col(V.EVENT_DATE) < split) | ((F.col(V.EVENT_DATE) == split) & (F.col("event_type") == F.lit("click")))
    early = F.coalesce(early, F.lit(False))
    runs = [(LANDING_RUNS[0], tgt.where(early)), (LANDING_RUNS[1], tgt.where(~early)), (None, None)]
    for run_date, part in runs:
        if part is not None:
            extract_to_landing(part, landing, run_date)
        audit_landing_stream(spark, landing, V.EVENT_DATE, src, V.EVENT_DATE, audit, ckpt, a["dag_name"],
                             a["source_tables"], a["target_table"], SUCCEEDED, a["start_ts"], a["end_ts"],
                             a["run_date"], counts_path=f"{root}/counts")
    return read_stream_audit(spark, audit)


def q_kpi_job_roundtrip(spark, sf_dir):
    """The whole KPI job: mart written, then published from the written table and written again."""
    settings = KpiJobSettings(country=SETTINGS["country"], bu=None, source_system=None,
                              org_code=SETTINGS["org_code"], as_of=SETTINGS["as_of"], money="cents", stage=True)
    root = scratch_path(spark, "kpi-job")
    out = run_kpi_job(V.transactions(spark, sf_dir), V.external_id_map(spark, sf_dir), SPEC, settings,
                      f"{root}/mart", f"{root}/published")
    return out["published"]


def q_table_count_audit_roundtrip(spark, sf_dir):
    """Per-table audit appended, then read back for this dag and run epoch."""
    a = AUDIT
    path = scratch_path(spark, "audit-old")
    rows = table_count_audit(_count_tables(spark, sf_dir), a["dag_name"], "success", a["run_date"],
                             a["epoch_time"])
    append_audit(rows, path, partition_by=("load_date",))
    append_audit(table_count_audit(_count_tables(spark, sf_dir), "other_dag", "success", a["run_date"],
                                   a["epoch_time"]), path, partition_by=("load_date",))
    return read_audit(spark, path, dag_name=a["dag_name"], epoch_time=a["epoch_time"])


SINK_QUERIES = {
    "export_sql": q_export_sql,
    "landing_roundtrip": q_landing_roundtrip,
    "kpi_overwrite_roundtrip": q_kpi_overwrite_roundtrip,
    "kpi_overwrite_broken": q_kpi_overwrite_broken,
    "kpi_mart_incremental": q_kpi_mart_incremental,
    "audit_append_after_older": q_audit_append_after_older,
    "reconcile_ledger": q_reconcile_ledger,
    "increment_high_water": q_increment_high_water,
    "table_count_audit_observed": q_table_count_audit_observed,
    "extract_balanced": q_extract_balanced,
    "audit_append_roundtrip": q_audit_append_roundtrip,
    "landing_stream_audit": q_landing_stream_audit,
    "kpi_job_roundtrip": q_kpi_job_roundtrip,
    "table_count_audit_roundtrip": q_table_count_audit_roundtrip,
}


def queries() -> dict:
    out = dict(KPI_QUERIES)
    out.update(AUDIT_QUERIES)
    out.update(SINK_QUERIES)
    return out
