"""A key holding a large share of the rows: results stay whole and every shuffle carries partial aggregates."""

import datetime as dt
import re

from tallyspark import columns as C
from tallyspark.operators.business_unit import select_business_unit
from tallyspark.operators.kpi import kpi_mart
from tallyspark.operators.publish import publish_external

from fixtures import SMALL_SPEC, TRX_SCHEMA
from test_plans import _plan


def _rows(n_hot=3000, n_cold=60):
    t0 = dt.datetime(2000, 1, 1)
    hot = [(7, t0 + dt.timedelta(minutes=i), 1.0, i, "fsn_new", "971002", "KSA", "A") for i in range(n_hot)]
    cold = [(100 + i, t0 + dt.timedelta(days=i % 30), 2.0, 10_000 + i, "fsn_new", "971002", "KSA", "B")
            for i in range(n_cold)]
    return hot + cold


def test_hot_customer_and_shared_external_id(spark):
    trx = spark.createDataFrame(_rows(), TRX_SCHEMA).repartition(8)
    mart = kpi_mart(select_business_unit(trx, "KSA", as_of="2001-01-01"), SMALL_SPEC)
    plan = _plan(mart).split("===== Subqueries =====")[0]  # planned, not yet run
    tree = plan.split("\n\n")[0]
    # two hash exchanges (plus the fixture's round robin), each on top of a partial aggregate
    assert tree.count("Exchange") == 3, tree
    lines = [ln.strip(" :+-") for ln in tree.splitlines()]
    for i, ln in enumerate(lines):
        if ln.startswith("Exchange") and i + 1 < len(lines) and not lines[i + 1].startswith("Project"):
            assert lines[i + 1].startswith("HashAggregate"), (ln, lines[i + 1])
    assert len(re.findall(r"partial_", plan)) >= 2
    got = {r[C.CUSTOMER]: r for r in mart.collect()}
    assert len(got) == 61
    assert got[7]["cnt_a_life"] == 3000  # whole, not capped
    # every customer shares one external id: one published row, the smallest key
    ext = spark.createDataFrame([("FSN", k, "SAME") for k in got if k is not None],
                                f"{C.ORG_CODE} string, {C.GCR_ID} bigint, {C.EXTERNAL_ID} string")
    pub = publish_external(mart, ext, "FSN").collect()
    assert len(pub) == 1 and pub[0][C.GCR_ID] == 7 and pub[0]["cnt_a_life"] == 3000
