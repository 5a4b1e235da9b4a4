"""Property: reconciliation and audit rows equal a plain-Python brute force on random rows."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyspark import columns as C
from tallyspark.operators.audit import FAILED, SUCCEEDED, audit_rows
from tallyspark.operators.increments import increment_dates
from tallyspark.operators.reconcile import reconcile, reconcile_source_dates

DAYS = [dt.date(2024, 1, d) for d in range(1, 6)]
src_row = st.tuples(st.one_of(st.none(), st.sampled_from(DAYS)), st.sampled_from(["a", "b"]))
tgt_row = st.tuples(st.one_of(st.none(), st.sampled_from(DAYS)), st.integers(0, 20))


def brute(src, tgt, inc, tgt_min=None):
    out = {}
    for d in inc:
        s = sum(1 for r in src if r[0] == d)
        t = sum(1 for r in tgt if r[0] == d and (tgt_min is None or r[1] >= tgt_min))
        out[d] = (s, t)
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(src=st.lists(src_row, max_size=25), tgt=st.lists(tgt_row, max_size=25),
       inc=st.lists(st.sampled_from(DAYS), max_size=4, unique=True), failed=st.booleans())
def test_reconcile_and_audit_equal_brute_force(spark, src, tgt, inc, failed):
    s = spark.createDataFrame(src, "d date, kind string")
    t = spark.createDataFrame(tgt, "d date, v int")
    i = spark.createDataFrame([(d,) for d in inc], f"{C.INC_DATE} date")
    got = {r[0]: (r[1], r[2]) for r in reconcile(i, s, t, "d", "d", target_filter="v >= 10").collect()}
    assert got == brute(src, tgt, inc, tgt_min=10)
    pruned = {r[0]: (r[1], r[2]) for r in
              reconcile(i, s, t, "d", "d", target_filter="v >= 10", prune_to_range=True).collect()}
    assert pruned == got
    own = sorted({r[0] for r in src if r[0] is not None})
    one_pass = {r[0]: (r[1], r[2]) for r in reconcile_source_dates(s, t, "d", "d").collect()}
    assert one_pass == brute(src, tgt, own)
    assert {r[0] for r in increment_dates(s, "d").collect()} == set(own)
    status = FAILED if failed else SUCCEEDED
    rows = audit_rows(reconcile(i, s, t, "d", "d"), "dag", ["s"], "t", status, "a", "b", "2024-02-01").collect()
    want = brute(src, tgt, inc)
    if not inc:
        assert [(r["trx_date"], r["source_count"], r["target_count"]) for r in rows] == [(None, 0, 0)]
    else:
        assert {r["trx_date"]: (r["source_count"], r["target_count"]) for r in rows} == \
            {d: (sc, 0 if failed else tc) for d, (sc, tc) in want.items()}
