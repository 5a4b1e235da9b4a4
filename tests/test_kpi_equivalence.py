"""The two-stage mart equals the per-column filter / aggregate / left-join chain on the supplied tables."""

import math

from pyspark.sql import functions as F

from tallyspark import columns as C
from tallyspark.functions.dates import months_back
from tallyspark.operators.business_unit import select_business_unit
from tallyspark.operators.kpi import kpi_mart
from tallyspark.plans import supplied_tables_spec
from tallyspark.sources import retail_views as V


def chain_mart(bu, spec):
    """The slow shape, for tests only: one filtered aggregate and one left join per column."""
    anchor = bu.agg(F.max(C.TRX_DATE).alias("mx")).collect()[0]["mx"]
    out = bu.select(C.CUSTOMER).distinct()
    for cell in spec.cells():
        rows = bu.where(F.col(C.BRAND) == cell.brand_literal)
        bound = None if cell.months is None else months_back(F.lit(anchor), cell.months)
        if cell.measure in ("sum", "avg", "count") and bound is not None:
            rows = rows.where(F.col(C.TRX_DATE) >= bound)
        g = rows.groupBy(C.CUSTOMER)
        if cell.measure == "sum":
            part = g.agg(F.sum(C.AMOUNT).alias(cell.name))
        elif cell.measure == "avg":
            part = g.agg(F.avg(C.AMOUNT).alias(cell.name))
        elif cell.measure == "count":
            part = g.agg(F.count(C.TXN_ID).alias(cell.name))
        else:
            last = g.agg(F.max(C.TRX_DATE).alias("_last"))
            active = F.when(F.col("_last") >= bound, F.lit(1))
            flag = active if cell.measure == "active" else F.when(active.isNull(), F.lit(1))
            part = last.select(C.CUSTOMER, flag.alias(cell.name))
        out = out.join(part, C.CUSTOMER, "left")
    return out


def test_two_stage_equals_chain(spark, sf_small):
    spec = supplied_tables_spec()
    bu = select_business_unit(V.transactions(spark, sf_small), "ASIA", as_of="2001-06-30")
    fast = {r[C.CUSTOMER]: r.asDict() for r in kpi_mart(bu, spec).collect()}
    slow = {r[C.CUSTOMER]: r.asDict() for r in chain_mart(bu, spec).collect()}
    assert fast.keys() == slow.keys() and len(fast) > 0
    non_null = 0
    for k, row in slow.items():
        for col, v in row.items():
            w = fast[k][col]
            if v is None:
                assert w is None, (k, col)
            else:
                non_null += 1
                assert w is not None and math.isclose(w, v, rel_tol=1e-9, abs_tol=1e-6), (k, col, v, w)
    assert non_null > len(fast)  # the comparison saw real values
