"""Property: external-id publishing equals a plain-Python brute force on random maps."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyspark import columns as C
from tallyspark.operators.publish import publish_external

kpi_rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(1, 8)), st.integers(0, 99)),
                    max_size=10, unique_by=lambda r: r[0])
map_rows = st.lists(st.tuples(st.sampled_from(["FSN", "OTHER"]), st.integers(1, 10),
                              st.one_of(st.none(), st.sampled_from(["E1", "E2", "E3", "E4"]))), max_size=14)


def brute(kpis, ext, org):
    pairs = {(g, e) for o, g, e in ext if o == org}
    joined = [(k, v, g, e) for k, v in kpis for g, e in pairs if k is not None and k == g]
    best = {}
    for k, v, g, e in joined:
        if e not in best or g < best[e][1]:
            best[e] = (v, g)
    return sorted(((v, g, e) for e, (v, g) in best.items()), key=_key)


def _key(t):
    return (t[2] is None, t[2] or "", t[0], t[1])


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(kpis=kpi_rows, ext=map_rows)
def test_publish_equals_brute_force(spark, kpis, ext):
    k = spark.createDataFrame(kpis, f"{C.CUSTOMER} bigint, kpi int")
    m = spark.createDataFrame(ext, f"{C.ORG_CODE} string, {C.GCR_ID} bigint, {C.EXTERNAL_ID} string")
    got = sorted(((r["kpi"], r[C.GCR_ID], r[C.CUSTOMER]) for r in publish_external(k, m, "FSN").collect()),
                 key=_key)
    assert got == brute(kpis, ext, "FSN")
