import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyspark.session import scratch_path
from tallyspark.sources.export import export_sql
from tallyspark.sources.sinks import append_audit, extract_to_landing, read_audit, read_kpi, read_landing, write_kpi


def test_kpi_overwrite_replaces_schema(spark):
    path = scratch_path(spark, "t-kpi")
    write_kpi(spark.createDataFrame([(1, 2.0)], "k bigint, a double"), path)
    write_kpi(spark.createDataFrame([(1, "x"), (2, "y")], "k bigint, b string"), path)
    back = read_kpi(spark, path)
    assert back.columns == ["k", "b"] and back.count() == 2


def test_audit_append_accumulates_and_reads_back(spark):
    path = scratch_path(spark, "t-audit")
    df = spark.createDataFrame([("d1", "t", 1, dt.date(2024, 2, 1))],
                               "dag_name string, table_name string, epoch_time bigint, run_date date")
    append_audit(df, path)
    append_audit(df, path)
    assert read_audit(spark, path).count() == 2
    assert read_audit(spark, path, dag_name="d1", table_name="t", epoch_time=1).count() == 2
    assert read_audit(spark, path, dag_name="other").count() == 0


def test_landing_replaces_only_its_day(spark):
    path = scratch_path(spark, "t-landing")
    a = spark.createDataFrame([(1,), (2,)], "v int")
    extract_to_landing(a, path, "2024-02-01")
    extract_to_landing(a, path, dt.date(2024, 2, 2))
    extract_to_landing(a.where("v = 1"), path, "2024-02-01")
    assert read_landing(spark, path, "2024-02-01").count() == 1
    assert read_landing(spark, path, "2024-02-02").count() == 2
    plan = read_landing(spark, path, "2024-02-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "run_date" in plan


def test_export_sql_with_frames(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    assert export_sql(spark, "SELECT sum(v) AS s FROM {t}", t=df).collect()[0]["s"] == 6


def test_audit_append_with_unique_key_is_idempotent(spark):
    path = scratch_path(spark, "t-audit-idem")
    df = spark.createDataFrame([("h1", dt.date(2024, 2, 1)), ("h2", dt.date(2024, 2, 1))], "hash string, run_date date")
    append_audit(df, path, unique_key="hash")
    append_audit(df, path, unique_key="hash")  # a retried run
    more = spark.createDataFrame([("h2", dt.date(2024, 2, 1)), ("h3", dt.date(2024, 2, 2))], "hash string, run_date date")
    append_audit(more, path, unique_key="hash")
    assert sorted(r["hash"] for r in read_audit(spark, path).collect()) == ["h1", "h2", "h3"]


def test_empty_re_extract_replaces_the_day(spark):
    path = scratch_path(spark, "t-land-empty")
    rows = spark.createDataFrame([(1,), (2,)], "x int")
    extract_to_landing(rows, path, "2024-01-05")
    extract_to_landing(rows.where("x = 1"), path, "2024-01-06")
    extract_to_landing(rows.where("x > 9"), path, "2024-01-05")
    assert read_landing(spark, path, "2024-01-05").count() == 0
    assert [r["x"] for r in read_landing(spark, path).collect()] == [1]
    extract_to_landing(rows, path, "2024-01-05")
    assert read_landing(spark, path, "2024-01-05").count() == 2
    with pytest.raises(ValueError):
        extract_to_landing(rows.selectExpr("x as run_date"), path, "2024-01-05")


def test_failed_overwrite_keeps_the_old_mart(spark):
    path = scratch_path(spark, "t-keep")
    write_kpi(spark.range(3), path)
    with pytest.raises(Exception):
        write_kpi(spark.range(3).selectExpr("assert_true(id < 1) as x", "id"), path)
    assert read_kpi(spark, path).count() == 3


def test_run_id_makes_a_retry_idempotent_and_drops_no_other_run_date(spark):
    path = scratch_path(spark, "t-run-id")
    row = lambda end, day: spark.sql(
        f"select 'h' as hash, '{end}' as end_ts, date'2024-01-01' as trx_date, date'{day}' as run_date")
    append_audit(row("1", "2024-02-01"), path, run_id="r1", run_date="2024-02-01")
    append_audit(row("2", "2024-02-01"), path, run_id="r1", run_date="2024-02-01")  # a retry, later
    append_audit(row("1", "2024-02-02"), path, run_id="r1", run_date="2024-02-02")
    append_audit(row("1", "2024-02-02"), path, run_id="r2", run_date="2024-02-02")
    got = sorted((r["run_id"], str(r["run_date"])) for r in read_audit(spark, path).collect())
    assert got == [("r1", "2024-02-01"), ("r1", "2024-02-02"), ("r2", "2024-02-02")]


def test_cents_of_large_decimals_and_sql_with_braces(spark):
    from tallyspark.functions.money import to_cents
    from tallyspark.sources.export import export_sql
    df = spark.sql("select cast('90071992547409.93' as decimal(18,2)) as a, 1.15D as b, '2024' as y")
    assert tuple(df.select(to_cents(F.col("a")), to_cents(F.col("b"))).first()) == (9007199254740993, 115)
    assert export_sql(spark, "select y from {src} where y rlike '^[0-9]{4}$'", src=df).count() == 1


def test_scratch_needs_the_shared_folder_on_a_cluster():
    from tallyspark.session import checkpoint_root

    class Conf:
        get = staticmethod(lambda key, default=None: default)

    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(Conf)
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session)
