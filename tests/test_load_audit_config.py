import datetime as dt
import json

import pytest

from tallyspark.operators.audit import SUCCEEDED
from tallyspark.plans.load_audit_config import LoadAuditConfig, run_load_audit, unset

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def _params(**over):
    p = {
        "incerment_query": "None", "src_table_or_view": "t_src", "src_incremental_column": "d",
        "filter_on_scr_query": "None", "scr_query": "None", "excel_table": "t_tgt",
        "excel_incremental_column": "d", "filter_on_excel_query": "NONE ", "excel_query": "none",
        "source_tables": ["s1", "s2"], "dag_audit_src_tbl": ["t_src", "t_tgt"], "dag_audit_table_type": ["src", "tgt"],
        "dag_audit_src_tbl_count_sql": ["select count(*) from t_src where k = 1", "select count(*) from t_tgt"],
        "load_date_range": ["current_date()", "current_date()"],
    }
    p.update(over)
    return p


def _views(spark):
    spark.createDataFrame([(D1, 1), (D1, 0), (D2, 1)], "d date, k int").createOrReplaceTempView("t_src")
    spark.createDataFrame([(D1, 1)], "d date, k int").createOrReplaceTempView("t_tgt")


def test_none_sentinel():
    assert unset(None) and unset("None") and unset(" none ") and not unset("select 1")


def test_mismatched_audit_lists_are_rejected():
    cfg = LoadAuditConfig.from_params(_params(dag_audit_src_tbl=["only_one"]), "dag")
    assert cfg.count_tables == () and "1 tables" in cfg.count_tables_mismatch


def test_from_json_nested_block():
    text = json.dumps({"dag_config": {"default_args": {"owner": "x", "params": _params()}}})
    cfg = LoadAuditConfig.from_json(text, "dag")
    assert cfg.source == "t_src" and cfg.target_filter is None and cfg.source_tables == ("s1", "s2")


def test_default_counts(spark):
    _views(spark)
    out = run_load_audit(spark, LoadAuditConfig.from_params(_params(), "dag"), SUCCEEDED, "a", "b", "2024-02-01", 7)
    rows = {r["trx_date"]: (r["source_count"], r["target_count"]) for r in out["audit_rows"].collect()}
    assert rows == {D1: (2, 1), D2: (1, 0)}
    counts = {r["table_name"]: r["count"] for r in out["table_count_audit"].collect()}
    assert counts == {"t_src": 2, "t_tgt": 1}


def test_custom_queries_and_increment_query(spark):
    _views(spark)
    params = _params(incerment_query="SELECT DATE'2024-01-02'", scr_query="select count(*) from t_src",
                     excel_query="select count(*) from t_tgt where k = 1")
    out = run_load_audit(spark, LoadAuditConfig.from_params(params, "dag"), SUCCEEDED, "a", "b", "2024-02-01")
    rows = [(r["trx_date"], r["source_count"], r["target_count"]) for r in out["audit_rows"].collect()]
    assert rows == [(D2, 3, 1)]


def test_counts_from_queries_and_one_audit_table_for_two_queries(spark):
    """Both counts from queries, today as the increment; the per-table lists do not pair up."""
    _views(spark)
    params = _params(  # fixed names: the keys of the existing configuration files
        incerment_query="select current_date() as day", src_table_or_view="NONE", src_incremental_column=" none ",
        scr_query="select count(1) from t_src where k > 0", excel_incremental_column="None",
        excel_query="select 40 + 2", dag_audit_src_tbl=["t_src"], dag_audit_table_type=["src", "tgt"],
        dag_audit_src_tbl_count_sql=["select count(1) from t_src", "select count(1) from t_tgt"])
    out = run_load_audit(spark, LoadAuditConfig.from_params(params, "dag"), SUCCEEDED, "a", "b", "2024-02-01", 7)
    rows = out["audit_rows"].collect()
    assert len(rows) == 1 and rows[0]["target_count"] == 42
    assert "table_count_audit" not in out and "2 count queries" in out["table_count_mismatch"]
