import datetime as dt

from tallyspark import columns as C
from tallyspark.operators.audit import (FAILED, SUCCEEDED, audit_rows, audit_summary, load_status,
                                        table_count_audit)
from tallyspark.operators.increments import increment_dates, increment_dates_sql
from tallyspark.operators.reconcile import reconcile

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def _src(spark):
    return spark.createDataFrame(
        [(D1, "a", 1), (D1, "b", 0), (D2, "a", 1), (None, "a", 1), (D1, "a", 1)],
        "d date, kind string, active_flag int")


def _tgt(spark):
    return spark.createDataFrame([(D1, "a"), (D3, "a")], "d date, kind string")


def test_increments_drop_null_and_dedupe(spark):
    got = sorted(r[0] for r in increment_dates(_src(spark), "d").collect())
    assert got == [D1, D2]
    q = increment_dates_sql(spark, "SELECT d FROM {t} WHERE kind = 'b'", t=_src(spark))
    assert [r[0] for r in q.collect()] == [D1]


def test_reconcile_default_filtered_custom(spark):
    src, tgt = _src(spark), _tgt(spark)
    inc = spark.createDataFrame([(D1,), (D2,), (D3,)], f"{C.INC_DATE} date")
    plain = {r[0]: (r[1], r[2]) for r in reconcile(inc, src, tgt, "d", "d").collect()}
    assert plain == {D1: (3, 1), D2: (1, 0), D3: (0, 1)}
    filt = {r[0]: (r[1], r[2]) for r in
            reconcile(inc, src, tgt, "d", "d", source_filter="AND active_flag = 1").collect()}
    assert filt == {D1: (2, 1), D2: (1, 0), D3: (0, 1)}
    custom = spark.sql("SELECT count(*) FROM {t}", t=tgt)
    cust = {r[0]: (r[1], r[2]) for r in reconcile(inc, src, tgt, "d", "d", target_count=custom).collect()}
    assert cust == {D1: (3, 2), D2: (1, 2), D3: (0, 2)}
    # a filter wins over a custom count
    both = {r[0]: r[2] for r in reconcile(inc, src, tgt, "d", "d", target_filter="kind = 'a'",
                                             target_count=custom).collect()}
    assert both == {D1: 1, D2: 0, D3: 1}


def _recon(spark, rows):
    return spark.createDataFrame(rows, f"{C.INC_DATE} date, source_count bigint, target_count bigint")


def test_audit_rows_success_failed_empty(spark):
    recon = _recon(spark, [(D1, 3, 1), (D2, 1, 0)])
    kw = dict(dag_name="dag", source_tables=["s1", "s2"], target_table="t", start_ts="2024-02-01 05:00:00 AM",
              end_ts="2024-02-01 05:20:00 AM", run_date="2024-02-01")
    ok = audit_rows(recon, status=SUCCEEDED, **kw)
    assert ok.columns == C.AUDIT_COLUMNS
    rows = sorted(ok.collect(), key=lambda r: r["trx_date"])
    assert [(r["source_count"], r["target_count"]) for r in rows] == [(3, 1), (1, 0)]
    assert rows[0]["source_tables"] == "s1,s2" and rows[0]["run_date"] == dt.date(2024, 2, 1)
    assert len(rows[0]["hash"]) == 64
    again = sorted(audit_rows(recon, status=SUCCEEDED, **kw).collect(), key=lambda r: r["trx_date"])
    assert [r["hash"] for r in again] == [r["hash"] for r in rows]  # repeatable
    bad = sorted(audit_rows(recon, status=FAILED, **kw).collect(), key=lambda r: r["trx_date"])
    assert [(r["source_count"], r["target_count"]) for r in bad] == [(3, 0), (1, 0)]
    assert bad[0]["hash"] != rows[0]["hash"]
    empty = audit_rows(_recon(spark, []), status=SUCCEEDED, **kw).collect()
    assert len(empty) == 1 and empty[0]["trx_date"] is None
    assert (empty[0]["source_count"], empty[0]["target_count"]) == (0, 0)


def test_audit_default_timestamps_have_am_pm(spark):
    r = audit_rows(_recon(spark, [(D1, 1, 1)]), "dag", "s", "t", SUCCEEDED).collect()[0]
    assert r["start_ts"][-2:] in ("AM", "PM") and len(r["start_ts"]) == 22


def test_table_count_audit_and_summary(spark):
    src, tgt = _src(spark), _tgt(spark)
    tables = [("src_tbl", "src", src.where("active_flag = 1")), ("tgt_tbl", "tgt", tgt)]
    old = {r["table_name"]: r.asDict() for r in
           table_count_audit(tables, "dag", load_status(True) and "success", "2024-02-01", 42).collect()}
    assert old["src_tbl"]["count"] == 4 and old["tgt_tbl"]["count"] == 2
    assert old["src_tbl"]["epoch_time"] == 42 and old["src_tbl"]["load_date"] == dt.date(2024, 2, 1)
    s = {r["table_name"]: r["count"] for r in audit_summary(tables, "dag", FAILED, "2024-02-01").collect()}
    assert s == {"src_tbl": 4, "tgt_tbl": 0}
    s_ok = {r["table_name"]: r["count"] for r in audit_summary(tables, "dag", SUCCEEDED).collect()}
    assert s_ok == {"src_tbl": 4, "tgt_tbl": 2}
    assert load_status(False) == FAILED


def test_reconcile_pruned_to_increment_range_reads_only_those_partitions(spark):
    from tallyspark.session import scratch_path
    path = scratch_path(spark, "t-part-src")
    src = spark.createDataFrame([(D1, "a"), (D2, "a"), (D2, "b"), (D3, "a")], "d date, kind string")
    src.write.partitionBy("d").parquet(path)
    table = spark.read.parquet(path)
    inc = spark.createDataFrame([(D2,)], f"{C.INC_DATE} date")
    recon = reconcile(inc, table, table, "d", "d", target_filter="kind = 'a'", prune_to_range=True)
    assert [(r[0], r[1], r[2]) for r in recon.collect()] == [(D2, 2, 1)]
    jvm = spark._jvm
    plan = recon._jdf.queryExecution().explainString(jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    partition_filters = [ln for ln in plan.splitlines() if ln.startswith("PartitionFilters: [")]
    assert partition_filters and all("Subquery" in ln for ln in partition_filters)


def test_queries_with_dotted_generated_column_names(spark):
    src = _src(spark)
    q = increment_dates_sql(spark, "SELECT max(t.d) FROM {t} t", t=src)
    assert [r[0] for r in q.collect()] == [D2]
    inc = spark.createDataFrame([(D1,)], f"{C.INC_DATE} date")
    custom = spark.sql("SELECT count(t.d) FROM {t} t", t=src)
    assert reconcile(inc, src, src, "d", "d", source_count=custom).collect()[0][1] == 4


def test_reconcile_source_dates_equals_generic_form(spark):
    from tallyspark.operators.reconcile import reconcile_source_dates
    src, tgt = _src(spark), _tgt(spark)
    generic = sorted(tuple(r) for r in reconcile(increment_dates(src, "d"), src, tgt, "d", "d").collect())
    one_pass = sorted(tuple(r) for r in reconcile_source_dates(src, tgt, "d", "d").collect())
    assert generic == one_pass == [(D1, 3, 1), (D2, 1, 0)]


def test_audit_timestamp_text_from_datetime(spark):
    r = audit_rows(_recon(spark, [(D1, 1, 1)]), "dag", "s", "t", SUCCEEDED,
                   dt.datetime(2024, 2, 1, 17, 3, 4), dt.datetime(2024, 2, 1, 5, 0, 0), dt.date(2024, 2, 1)).collect()[0]
    assert (r["start_ts"], r["end_ts"]) == ("2024-02-01 17:03:04 PM", "2024-02-01 05:00:00 AM")
    assert r["run_date"] == dt.date(2024, 2, 1)
