"""Plan shape: one scan per pass, filters in the scan, no Python in the plan, two shuffles for the mart."""

import os
import re
import sys

from tallyspark.operators.business_unit import select_business_unit
from tallyspark.operators.kpi import kpi_mart
from tallyspark.plans import LIFESTYLE_SPEC
from tallyspark.session import scratch_path

from fixtures import AS_OF, ROWS, TRX_SCHEMA


def _plan(df):
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_kpi_mart_plan_shape(spark):
    path = scratch_path(spark, "t-trx")
    spark.createDataFrame(ROWS, TRX_SCHEMA).write.parquet(path)
    trx = spark.read.parquet(path)
    mart = kpi_mart(select_business_unit(trx, "KSA", "fsn_new", "971002", as_of=AS_OF), LIFESTYLE_SPEC)
    plan = _plan(mart)
    # the anchor is one scalar subquery, planned once
    assert len(set(re.findall(r"Subquery subquery#\d+", plan))) == 1, re.findall(r"Subquery subquery#\d+", plan)
    # no Python evaluation anywhere
    assert "EvalPython" not in plan and "PythonUDF" not in plan
    # country / BU / source system / as-of reach the parquet scan
    for needle in ("EqualTo(des_country_name,KSA)", "EqualTo(bu,fsn_new)", "EqualTo(cod_sor_gr,971002)",
                   "LessThanOrEqual(dat_date_type_1"):
        assert needle in plan, needle
    # the main scan reads only the used columns (country etc. are only filtered on)
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)
    assert schemas and all("des_maf_brand_name" in s or "cua_amount_type_1" not in s for s in schemas)
    # two shuffles in the main plan: customer x brand, then customer
    main = plan.split("===== Subqueries =====")[0]
    tree = main.split("\n\n")[0]
    assert tree.count("Exchange") == 2, tree
    assert mart.count() == 7  # customers 1-6 and the NULL key


def test_entry_contract(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    df = E.entry(spark)
    assert len(df.columns) == 89 and df.count() > 0
