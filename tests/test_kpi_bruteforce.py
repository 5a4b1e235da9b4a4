"""Property: the mart in cents equals a plain-Python brute force of the KPI rules on random rows."""

import calendar
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyspark import columns as C
from tallyspark.operators.business_unit import select_business_unit
from tallyspark.operators.kpi import kpi_mart

from fixtures import SMALL_SPEC, TRX_SCHEMA

AS_OF = dt.datetime(2001, 1, 1)
BASE = dt.datetime(2000, 1, 1)

# dates over ~16 months (some after AS_OF), month ends included, times of day varied
row = st.tuples(
    st.sampled_from([None, 1, 2, 3]),
    st.one_of(st.none(),
              st.integers(0, 480).map(lambda d: BASE + dt.timedelta(days=d, hours=(d * 7) % 24)),
              st.sampled_from([dt.datetime(2000, 3, 31, 10), dt.datetime(2000, 12, 31, 23),
                               dt.datetime(2000, 2, 29, 10)])),
    st.one_of(st.none(), st.integers(0, 5000).map(lambda c: c / 100)),
    st.one_of(st.none(), st.integers(1, 50)),
    st.sampled_from(["A", "B", "Z", None]),
).map(lambda r: (r[0], r[1], r[2], r[3], "fsn_new", "971002", "KSA", r[4]))


def months_back(t, n):
    y, m = divmod(t.year * 12 + (t.month - 1) - n, 12)
    day = min(t.day, calendar.monthrange(y, m + 1)[1])
    return t.replace(year=y, month=m + 1, day=day)


def half_up(s, n):
    q = (2 * abs(s) + n) // (2 * n)
    return q if s >= 0 else -q


def brute_force(rows, spec):
    """The KPI rules written out directly: filter, anchor, then one value per customer and cell."""
    kept = [r for r in rows if r[1] is not None and r[1] <= AS_OF]
    if not kept:
        return {}
    anchor = max(r[1] for r in kept)
    out = {}
    for cust in {r[0] for r in kept}:
        vals = {}
        for cell in spec.cells():
            mine = [r for r in kept if r[0] == cust and cust is not None and r[7] == cell.brand_literal]
            bound = None if cell.months is None else months_back(anchor, cell.months)
            inw = [r for r in mine if bound is None or r[1] >= bound]
            cents = [round(r[2] * 100) for r in inw if r[2] is not None]
            if cell.measure == "sum":
                v = sum(cents) if cents else None
            elif cell.measure == "avg":
                v = half_up(sum(cents), len(cents)) if cents else None
            elif cell.measure == "count":
                v = sum(1 for r in inw if r[3] is not None) if inw else None
            elif cell.measure == "active":
                v = 1 if inw else None
            else:
                v = 1 if (mine and not inw) else None
            vals[cell.name] = v
        out[cust] = vals
    return out


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=30))
def test_cents_mart_equals_brute_force(spark, rows):
    bu = select_business_unit(spark.createDataFrame(rows, TRX_SCHEMA), "KSA", as_of=AS_OF.date())
    got = {r[C.CUSTOMER]: {k: v for k, v in r.asDict().items() if k != C.CUSTOMER}
           for r in kpi_mart(bu, SMALL_SPEC, money="cents").collect()}
    assert got == brute_force(rows, SMALL_SPEC)
