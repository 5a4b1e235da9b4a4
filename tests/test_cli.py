import datetime as dt
import json

from tallyspark import columns as C
from tallyspark.__main__ import main
from tallyspark.session import scratch_path
from tallyspark.sources.sinks import read_kpi

from fixtures import ROWS, TRX_SCHEMA


def test_cli_kpi(spark):
    root = scratch_path(spark, "t-cli-kpi")
    spark.createDataFrame(ROWS, TRX_SCHEMA).write.parquet(f"{root}/trx")
    spark.createDataFrame([("FSN", 1, "X1"), ("FSN", 2, "X2")],
                          f"{C.ORG_CODE} string, {C.GCR_ID} bigint, {C.EXTERNAL_ID} string").write.parquet(f"{root}/ext")
    out = main(["kpi", "--transactions", f"{root}/trx", "--external-ids", f"{root}/ext", "--out", f"{root}/mart",
                "--published", f"{root}/pub", "--country", "KSA", "--bu", "fsn_new", "--source-system", "971002",
                "--as-of", "2001-01-01", "--stage"])
    assert len(read_kpi(spark, f"{root}/mart").columns) == 89
    assert sorted(r[C.CUSTOMER] for r in out["published"].collect()) == ["X1", "X2"]


def test_cli_audit(spark, tmp_path):
    root = scratch_path(spark, "t-cli-audit")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    spark.createDataFrame([(d1,), (d1,), (d2,)], "d date").write.parquet(f"{root}/src")
    spark.createDataFrame([(d1,)], "d date").write.parquet(f"{root}/tgt")
    params = {"incerment_query": "None", "src_table_or_view": "s_src", "src_incremental_column": "d",
              "filter_on_scr_query": "None", "scr_query": "None", "excel_table": "s_tgt",
              "excel_incremental_column": "d", "filter_on_excel_query": "None", "excel_query": "None",
              "source_tables": ["s_src"], "dag_audit_src_tbl": ["s_src"], "dag_audit_table_type": ["src"],
              "dag_audit_src_tbl_count_sql": ["select count(*) from s_src"], "load_date_range": ["current_date()"]}
    cfg = tmp_path / "config.json"
    cfg.write_text(json.dumps({"d_config": {"default_args": {"params": params}}}))
    args = ["audit", "--config", str(cfg), "--dag", "d", "--table", f"s_src={root}/src", "--table", f"s_tgt={root}/tgt",
            "--start-ts", "a", "--end-ts", "b", "--run-date", "2024-02-01", "--audit-path", f"{root}/audit",
            "--audit-old-path", f"{root}/audit_old", "--run-id", "r1"]
    main(args)
    main(args)  # a retried run adds no rows
    rows = {r["trx_date"]: (r["source_count"], r["target_count"]) for r in spark.read.parquet(f"{root}/audit").collect()}
    assert rows == {d1: (2, 1), d2: (1, 0)}
    assert spark.read.parquet(f"{root}/audit").count() == 2
    assert spark.read.parquet(f"{root}/audit_old").count() == 1  # the per-table audit knows its run as well


def test_cli_extract_from_files(spark):
    from tallyspark.sources.sinks import read_landing
    root = scratch_path(spark, "t-cli-extract")
    spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, kind string").write.parquet(f"{root}/src")
    main(["extract", "--source-path", f"{root}/src", "--query", "SELECT * FROM {source} WHERE kind = 'a'",
          "--landing", f"{root}/landing", "--run-date", "2024-02-01"])
    main(["extract", "--source-path", f"{root}/src", "--landing", f"{root}/landing", "--run-date", "2024-02-02"])
    assert read_landing(spark, f"{root}/landing", "2024-02-01").count() == 2
    assert read_landing(spark, f"{root}/landing", "2024-02-02").count() == 3
