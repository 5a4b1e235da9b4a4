"""State kept between runs: the mart's sums, count ledgers, loaded dates, versions, runs of the audit."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyspark import columns as C
from tallyspark.operators.audit import given_count, table_count_audit
from tallyspark.operators.count_ledger import ledger_counts, renew_counts
from tallyspark.operators.increments import loaded_dates, mark_loaded, open_dates
from tallyspark.operators.kpi import kpi_mart
from tallyspark.operators.kpi_state import advance_mart, rows_since, state_as_of
from tallyspark.plans.spec import ACTIVE, AVG, COUNT, INACTIVE, SUM, Brand, Family, KpiSpec
from tallyspark.session import scratch_path
from tallyspark.sources import sinks, versions
from tallyspark.sources.export import balanced_ranges, extract_ranges
from tallyspark.sources.files import Files
from tallyspark.sources.sinks import (append_audit, committed_runs, extract_to_landing, land_and_count, read_audit,
                                      read_kpi, read_landing, write_kpi)

SPEC = KpiSpec((Family("s1", 1, ((SUM, "sum_{code}_1"), (AVG, "avg_{code}_1"))),
                Family("c", None, ((COUNT, "n_{code}"),)), Family("c2", 2, ((COUNT, "n2_{code}"),)),
                Family("a", 2, ((ACTIVE, "on_{code}"), (INACTIVE, "off_{code}")))),
               (Brand("B1", "one"), Brand("B2", "two")))
SCHEMA = f"{C.CUSTOMER} bigint, {C.TRX_DATE} timestamp, {C.AMOUNT} double, {C.TXN_ID} bigint, {C.BRAND} string"


def transactions(seed, days):
    """Rows around midnight and month ends, with nulls, unlisted brands and days without any."""
    r = random.Random(seed)
    start = dt.datetime(2024, 1, 25)
    return [(r.choice([1, 2, 3, 4, None]), start + dt.timedelta(days=d, hours=r.choice([0, 0, 9, 23])),
             r.choice([None, round(r.uniform(-5, 90), 2)]), r.choice([None, d]), r.choice(["B1", "B2", "B3", None]))
            for d in range(days) if d % 7 for _ in range(r.randint(0, 4))]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_incremental_mart_equals_the_full_one(spark):
    """Runs of uneven steps, some without rows, over windows that lose days at month ends."""
    trx = spark.createDataFrame(transactions(5, 110), SCHEMA)
    path, last = scratch_path(spark, "t-state"), None
    for step in (40, 41, 60, 66, 67, 96, 97, 109):
        as_of = (dt.date(2024, 1, 25) + dt.timedelta(days=step)).isoformat()
        new = rows_since(trx, state_as_of(spark, path), as_of)
        if last is not None:
            assert new.where(F.col(C.TRX_DATE) <= F.lit(last).cast("date")).isEmpty()
        got = rows_of(advance_mart(new, path, SPEC, as_of))
        full = kpi_mart(trx.where(F.col(C.TRX_DATE) <= F.lit(as_of).cast("date")), SPEC, money="cents")
        assert got == rows_of(full), as_of
        assert rows_of(advance_mart(new, path, SPEC, as_of)) == got  # a repeated run changes nothing
        last = as_of
    with pytest.raises(ValueError):
        advance_mart(trx, path, SPEC.select(measures={SUM}), "2025-01-01")


def test_incremental_mart_takes_late_rows_and_survives_a_broken_run(spark, monkeypatch):
    rows = transactions(8, 90)
    early, late = [t for k, t in enumerate(rows) if k % 5], [t for k, t in enumerate(rows) if not k % 5]
    path = scratch_path(spark, "t-state")
    advance_mart(spark.createDataFrame(early, SCHEMA).where(f"{C.TRX_DATE} <= '2024-04-01'"), path, SPEC, "2024-04-01")
    second = spark.createDataFrame([t for t in early if t[1] > dt.datetime(2024, 4, 1)] + late, SCHEMA)
    with monkeypatch.context() as broken:
        broken.setattr(versions, "switch", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            advance_mart(second, path, SPEC, "2024-05-01")
    assert state_as_of(spark, path) == "2024-04-01"
    got = rows_of(advance_mart(second, path, SPEC, "2024-05-01"))
    assert got == rows_of(kpi_mart(spark.createDataFrame(rows, SCHEMA), SPEC, money="cents"))


def test_incremental_mart_reads_the_days_that_leave_only(spark, monkeypatch):
    """The plan of a new day's totals has the leaving days' folders as partition filters."""
    import tallyspark.operators.kpi_state as state
    trx = spark.createDataFrame(transactions(2, 80), SCHEMA)
    path = scratch_path(spark, "t-state")
    advance_mart(rows_since(trx, None, "2024-04-10"), path, SPEC, "2024-04-10")
    seen = {}
    inner = state._left_windows

    def spied(*args):
        seen["days"] = inner(*args)
        return seen["days"]

    monkeypatch.setattr(state, "_left_windows", spied)
    advance_mart(rows_since(trx, "2024-04-10", "2024-04-11"), path, SPEC, "2024-04-11")
    if "days" in seen:
        plan = seen["days"]._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in plan and "day#" in plan.split("PartitionFilters")[1].split("]")[0]
        assert {str(r[0])[:10] for r in seen["days"].select("_date").distinct().collect()} <= {
            "2024-02-10", "2024-02-11", "2024-03-10", "2024-03-11"}


def test_a_write_that_breaks_at_the_switch_leaves_the_old_table(spark, monkeypatch):
    path = scratch_path(spark, "t-version")
    write_kpi(spark.range(3), path)
    first = versions.current_version(spark, path)["version"]
    with monkeypatch.context() as broken:
        broken.setattr(Files, "_rename", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            write_kpi(spark.range(9), path)
    assert read_kpi(spark, path).count() == 3 and versions.current_version(spark, path)["version"] == first
    reader = read_kpi(spark, path)  # has begun with the old version
    write_kpi(spark.range(4), path)
    assert reader.count() == 3 and read_kpi(spark, path).count() == 4
    with pytest.raises(RuntimeError):
        versions.replace_table(spark.range(7), path, based_on=first)
    write_kpi(spark.range(5), path)
    assert len(Files(spark, path).names(f"{path}/versions")) <= 4 and read_kpi(spark, path).count() == 5
    assert spark.read.parquet(versions.version_folder(spark, path)).count() == 5
    with pytest.raises(FileNotFoundError):
        read_kpi(spark, scratch_path(spark, "t-none"))


def audit_row(spark, end, run_date="2024-02-01", dag="d"):
    return spark.sql(f"select '{dag}' as dag_name, '{end}' as end_ts, date'2024-01-01' as trx_date, "
                     f"date'{run_date}' as run_date")


def test_retry_adds_nothing_when_older_files_lack_the_run_id(spark):
    path = scratch_path(spark, "t-ledger")
    append_audit(audit_row(spark, "0"), path)
    for end in "12":
        append_audit(audit_row(spark, end), path, run_id="r", run_date="2024-02-01")
    append_audit(audit_row(spark, "3", dag="other"), path, run_id="r", run_date="2024-02-01")
    got = sorted((r["end_ts"], r["run_id"] or "") for r in read_audit(spark, path).collect())
    assert got == [("0", ""), ("1", "r"), ("3", "r")]
    assert sorted(e["run_id"] for e in committed_runs(spark, path)) == ["r", "r"]
    with pytest.raises(ValueError):
        append_audit(audit_row(spark, "4"), path, unique_key=["no_such", "dag_name"])


def test_a_run_that_broke_off_while_its_files_moved_is_finished_by_its_retry(spark, monkeypatch):
    path = scratch_path(spark, "t-ledger")
    two = audit_row(spark, "1").union(audit_row(spark, "1", "2024-02-02")).repartition(2, "run_date")
    moved = []
    inner = Files.move

    def once(self, source, target):
        if moved:
            raise OSError("lost")
        moved.append(target)
        inner(self, source, target)

    with monkeypatch.context() as broken:
        broken.setattr(Files, "move", once)
        with pytest.raises(OSError):
            append_audit(two, path, run_id="r")
    assert committed_runs(spark, path) == []
    append_audit(two, path, run_id="r")
    append_audit(two, path, run_id="r")
    assert sorted(str(r["run_date"]) for r in read_audit(spark, path).collect()) == ["2024-02-01", "2024-02-02"]
    assert len(committed_runs(spark, path)) == 1


def test_read_back_by_epoch_reads_its_day_only(spark):
    path = scratch_path(spark, "t-epoch")
    for epoch in (1706763600, 1706850000, 1706850001):
        rows = table_count_audit([given_count(spark, "t", "src", epoch % 100)], "d", "success", "2024-02-01", epoch)
        append_audit(rows, path, partition_by=("load_date",), run_id=f"r{epoch}", run_date="2024-02-01")
        append_audit(rows, path, partition_by=("load_date",), run_id=f"r{epoch}", run_date="2024-02-01")
    back = read_audit(spark, path, epoch_time=1706850000)
    assert [r["count"] for r in back.collect()] == [0] and sinks.EPOCH_DAY not in back.columns
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert sinks.EPOCH_DAY in plan.split("PartitionFilters")[1].split("]")[0]
    assert read_audit(spark, path).count() == 3


def test_count_ledger_reads_changed_partitions_only(spark):
    landing, ledger = scratch_path(spark, "t-landing"), scratch_path(spark, "t-counts")
    rows = spark.createDataFrame([(k, dt.date(2024, 1, 1 + k % 3) if k % 5 else None) for k in range(40)], "k int, d date")
    for day in ("2024-02-01", "2024-02-02", "2024-02-03"):
        extract_to_landing(rows, landing, day)
    assert len(renew_counts(spark, landing, ledger, "d")) == 3
    assert renew_counts(spark, landing, ledger, "d") == []

    def check():
        want = {r["d"]: r["n"] for r in read_landing(spark, landing).groupBy("d").agg(F.count("*").alias("n")).collect()}
        assert {r[C.INC_DATE]: r["n"] for r in ledger_counts(spark, ledger).collect()} == want

    check()
    extract_to_landing(rows.where("k < 11"), landing, "2024-02-02")
    extract_to_landing(rows.where("k < 0"), landing, "2024-02-03")
    assert renew_counts(spark, landing, ledger, F.col("d")) == ["run_date=2024-02-02", "run_date=2024-02-03"]
    check()
    Files(spark, landing).delete(f"{landing}/run_date=2024-02-01")
    # nothing is read for a folder that is gone, and no other partition is
    assert renew_counts(spark, landing, ledger, "d") == []
    check()


def test_open_dates_are_new_changed_or_emptied(spark):
    state = scratch_path(spark, "t-loaded")

    def run(counts, **more):
        df = spark.createDataFrame([(dt.date(2024, 1, d), n) for d, n in counts.items()] + [(None, 3)], f"{C.INC_DATE} date, n bigint")
        dates = open_dates(df, loaded_dates(spark, state), **more)
        got = {r[C.INC_DATE].day: r["loaded_count"] for r in dates.collect()}
        mark_loaded(dates, state)
        return got

    assert run({1: 5, 2: 6}) == {1: 5, 2: 6}
    assert run({1: 5, 2: 6}) == {}
    assert run({1: 7, 2: 6, 3: 1}) == {1: 7, 3: 1}
    assert run({2: 6, 3: 1}) == {1: 0} and run({2: 6, 3: 1}) == {}
    assert run({1: 4, 2: 9, 3: 1}, since="2024-01-02") == {2: 9}
    assert run({1: 4, 2: 9, 3: 1}) == {1: 4}


def test_counts_are_taken_while_landing(spark):
    path = scratch_path(spark, "t-seen")
    rows = spark.createDataFrame([(k, None if k == 3 else k % 2) for k in range(10)], "k int, odd int")
    calls = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def touched(k):
        calls.add(1)
        return k

    seen = land_and_count(rows.withColumn("k", touched("k")), path, "2024-02-01", {"odd": F.col("odd") == 1})
    assert seen == {"rows": 10, "odd": 4} and calls.value == 10
    assert read_landing(spark, path).count() == 10
    assert land_and_count(rows.where("k > 99"), path, "2024-02-01")["rows"] == 0


@pytest.mark.parametrize("key, spread, share", [("id * id", None, 2), ("id % 3", "id", 2), ("if(id % 3 = 0, 7, id)", "id", 2),
                                                ("if(id % 9 < 8, cast(id as bigint), null)", None, 2), ("7", "id", 2),
                                                ("7", None, 99)])
def test_balanced_ranges_hold_each_row_once(spark, key, spread, share):
    rows = spark.range(6000).selectExpr("id", f"{key} as k").withColumn("id", F.when(F.col("id") % 500 > 0, F.col("id")))
    ranges = balanced_ranges(rows, "k", 12, spread)
    counts = [rows.where(p).count() for p in ranges]
    assert sum(counts) == 6000
    held = extract_ranges(rows, ranges)
    assert held.where("extract_range is null").isEmpty()
    null_rows = rows.where("k is null").count()
    assert max(c for c in counts if c != null_rows or not null_rows) <= share * 6000 / 12
    assert balanced_ranges(rows.where("false"), "k", 4) == []


def test_failed_write_is_no_version(spark):
    path = scratch_path(spark, "t-broken")
    write_kpi(spark.range(3), path)
    with pytest.raises(PySparkException):
        write_kpi(spark.range(3).selectExpr("assert_true(id < 1) as x", "id"), path)
    assert read_kpi(spark, path).count() == 3
