from decimal import Decimal

from tallyspark import columns as C
from tallyspark.operators.publish import publish_external
from tallyspark.operators.quality import non_null_profile, round_floats


def test_round_floats_rounds_only_floating_columns(spark):
    df = spark.createDataFrame([(1, 1.005, 2.345, Decimal("1.005"), "x")],
                               "k bigint, a double, b float, d decimal(10,3), s string")
    r = round_floats(df).collect()[0]
    assert r["a"] == 1.01 and r["d"] == Decimal("1.005") and r["s"] == "x" and r["k"] == 1
    assert round_floats(df).columns == df.columns


def test_non_null_profile(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0), (None, None)], "a bigint, b double")
    got = {r[C.PROFILE_COLUMN]: r[C.PROFILE_COUNT] for r in non_null_profile(df).collect()}
    assert got == {"a": 2, "b": 1}


def test_publish_external(spark):
    kpis = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0), (None, 40.0), (4, 50.0)],
                                 f"{C.CUSTOMER} bigint, kpi double")
    ext = spark.createDataFrame([
        ("FSN", 1, "E1"), ("FSN", 1, "E2"),   # customer 1 has two ids
        ("FSN", 2, "E2"),                      # E2 shared by 1 and 2: smallest gcr_id wins
        ("FSN", 3, "E3"), ("FSN", 3, "E3"),   # duplicate pair
        ("OTHER", 4, "E4"),                    # other organisation
    ], f"{C.ORG_CODE} string, {C.GCR_ID} bigint, {C.EXTERNAL_ID} string")
    out = publish_external(kpis, ext, "FSN")
    assert out.columns == ["kpi", C.GCR_ID, C.CUSTOMER]
    got = sorted((r[C.CUSTOMER], r[C.GCR_ID], r["kpi"]) for r in out.collect())
    assert got == [("E1", 1, 10.0), ("E2", 1, 10.0), ("E3", 3, 30.0)]
