import datetime as dt

from tallyspark.operators.audit import SUCCEEDED
from tallyspark.session import scratch_path
from tallyspark.sources.sinks import extract_to_landing
from tallyspark.streaming import audit_landing_stream, read_stream_audit

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def test_each_run_audits_only_new_landing_files(spark):
    root = scratch_path(spark, "t-stream")
    landing, audit, ckpt = f"{root}/landing", f"{root}/audit", f"{root}/ckpt"
    source = spark.createDataFrame([(D1,), (D1,), (D2,), (D3,), (D3,), (D3,)], "d date")
    kw = dict(date_column="d", source=source, source_column="d", audit_path=audit, checkpoint_path=ckpt,
              dag_name="dag", source_tables=["s"], target_table="t", status=SUCCEEDED,
              start_ts="x", end_ts="y", run_date="2024-02-01")
    extract_to_landing(spark.createDataFrame([(D1,), (D2,)], "d date"), landing, "2024-01-05")
    audit_landing_stream(spark, landing, **kw)
    first = {r["trx_date"]: (r["source_count"], r["target_count"]) for r in read_stream_audit(spark, audit).collect()}
    assert first == {D1: (2, 1), D2: (1, 1)}
    extract_to_landing(spark.createDataFrame([(D3,), (D3,)], "d date"), landing, "2024-01-06")
    audit_landing_stream(spark, landing, **kw)
    df = spark.read.parquet(audit)
    per_batch = {(r["batch_id"], r["trx_date"]) for r in df.collect()}
    assert per_batch == {(0, D1), (0, D2), (1, D3)}
    second = {r["trx_date"]: (r["source_count"], r["target_count"]) for r in read_stream_audit(spark, audit).collect()}
    assert second == {D1: (2, 1), D2: (1, 1), D3: (3, 2)}
    # a run with nothing new leaves its marker row
    audit_landing_stream(spark, landing, **kw)
    marks = [r for r in read_stream_audit(spark, audit).collect() if r["trx_date"] is None]
    assert [(r["source_count"], r["target_count"]) for r in marks] == [(0, 0)]


def test_a_date_landed_over_two_runs_is_counted_in_full(spark):
    root = scratch_path(spark, "t-stream2")
    landing, audit, ckpt = f"{root}/landing", f"{root}/audit", f"{root}/ckpt"
    source = spark.createDataFrame([(D1,)] * 5, "d date")
    kw = dict(date_column="d", source=source, source_column="d", audit_path=audit, checkpoint_path=ckpt,
              dag_name="dag", source_tables=["s"], target_table="t", status=SUCCEEDED,
              start_ts="x", end_ts="y", run_date="2024-02-01")
    for day, n in (("2024-01-05", 3), ("2024-01-06", 2)):
        extract_to_landing(spark.createDataFrame([(D1,)] * n, "d date"), landing, day)
        audit_landing_stream(spark, landing, **kw)
    got = {(r["source_count"], r["target_count"]) for r in read_stream_audit(spark, audit).collect()}
    assert got == {(5, 3), (5, 5)}


def test_replayed_batch_replaces_its_rows(spark):
    from tallyspark.streaming.landing_audit import audit_batch
    root = scratch_path(spark, "t-replay")
    source = spark.createDataFrame([(D1,), (D2,)], "d date")
    batch = spark.createDataFrame([(D1,)], "d date")
    args = ("d", source, "d", f"{root}/audit", "dag", ["s"], "t", SUCCEEDED, "x", "y", "2024-02-01")
    audit_batch(batch, 5, *args)
    audit_batch(batch, 5, *args)  # the same batch after a failure: replaces, does not duplicate
    rows = read_stream_audit(spark, f"{root}/audit").collect()
    assert [(r["trx_date"], r["source_count"], r["target_count"]) for r in rows] == [(D1, 1, 1)]
