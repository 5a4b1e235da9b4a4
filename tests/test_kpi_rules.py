"""Rules of the KPI mart on hand-written rows."""

import datetime as dt

from pyspark.sql import functions as F

from tallyspark import columns as C
from tallyspark.operators.anchors import date_anchors
from tallyspark.operators.business_unit import customer_keys, select_business_unit
from tallyspark.operators.kpi import kpi_mart

from fixtures import AS_OF, ROWS, SMALL_SPEC, TRX_SCHEMA


def _bu(spark, rows=ROWS):
    trx = spark.createDataFrame(rows, TRX_SCHEMA)
    return select_business_unit(trx, "KSA", "fsn_new", "971002", as_of=AS_OF)


def _by_key(df):
    return {r[C.CUSTOMER]: r.asDict() for r in df.collect()}


def test_business_unit_filters(spark):
    bu = _bu(spark)
    got = sorted(r[C.TXN_ID] for r in bu.collect() if r[C.TXN_ID] is not None)
    # NULL date, future date, other country, other BU dropped
    assert 600 not in got and 601 not in got and 701 not in got and 800 not in got
    assert 602 in got and 700 in got
    assert bu.columns == C.TRANSACTION_COLUMNS


def test_population_includes_unlisted_brand_and_null_key(spark):
    keys = [r[0] for r in customer_keys(_bu(spark)).collect()]
    assert sorted(keys, key=lambda k: (k is None, k)) == [1, 2, 3, 4, 5, 6, None]
    m = kpi_mart(_bu(spark), SMALL_SPEC)
    assert m.count() == 7


def test_anchor_and_month_end_bound(spark):
    a = date_anchors(_bu(spark)).collect()[0]
    assert a["max_date"] == dt.datetime(2000, 3, 31, 10, 0)
    assert a["months_ago_1"] == dt.datetime(2000, 2, 29, 10, 0)  # clamped, time kept
    assert a["months_ago_12"] == dt.datetime(1999, 3, 31, 10, 0)
    assert a["days_ago_7"] == dt.datetime(2000, 3, 24, 10, 0)
    assert (a["current_month"], a["current_year"], a["previous_month"], a["previous_year"]) == (3, 2000, 2, 1999)
    assert a["current_month_start_date"] == "2000-03-01"
    assert a["min_date"] == dt.datetime(1999, 1, 1)


def test_window_bound_is_inclusive(spark):
    r = _by_key(kpi_mart(_bu(spark), SMALL_SPEC))
    # customer 1: the row exactly on the bound counts, the one an hour before does not
    assert r[1]["sum_a_1m"] == 10.0
    assert r[1]["avg_a_1m"] == 10.0
    assert r[1]["cnt_a_life"] == 2


def test_null_not_zero_for_absent_brand_or_window(spark):
    r = _by_key(kpi_mart(_bu(spark), SMALL_SPEC))
    # customer 2 bought A only long ago: sums NULL, lifetime count 1, inactive
    assert r[2]["sum_a_1m"] is None and r[2]["avg_a_1m"] is None
    assert r[2]["cnt_a_life"] == 1
    assert r[2]["active_a"] is None and r[2]["inactive_a"] == 1
    assert r[2]["active_b"] == 1 and r[2]["inactive_b"] is None
    # customer 1 never bought B: everything NULL, both flags NULL
    assert all(r[1][k] is None for k in ("sum_b_1m", "avg_b_1m", "cnt_b_life", "active_b", "inactive_b"))


def test_null_transaction_ids_count_zero(spark):
    r = _by_key(kpi_mart(_bu(spark), SMALL_SPEC))
    assert r[3]["cnt_b_life"] == 0
    assert r[3]["sum_b_1m"] == 3.0


def test_unlisted_brand_customer_and_null_key_rows_are_all_null(spark):
    r = _by_key(kpi_mart(_bu(spark), SMALL_SPEC))
    for key in (4, None):
        assert all(v is None for k, v in r[key].items() if k != C.CUSTOMER)


def test_future_and_null_dates_do_not_count(spark):
    r = _by_key(kpi_mart(_bu(spark), SMALL_SPEC))
    assert r[5]["cnt_a_life"] == 1 and r[5]["sum_a_1m"] == 4.0


def test_cents_form_matches_double_form(spark):
    d = _by_key(kpi_mart(_bu(spark), SMALL_SPEC))
    c = _by_key(kpi_mart(_bu(spark), SMALL_SPEC, money="cents"))
    assert c[2]["sum_b_1m"] == 750 and c[1]["avg_a_1m"] == 1000
    for k in d:
        for col in ("sum_a_1m", "sum_b_1m"):
            if d[k][col] is not None:
                assert round(d[k][col] * 100) == c[k][col]


def test_half_up_average_in_cents(spark):
    rows = [(1, dt.datetime(2000, 1, 1), 0.01, 1, "fsn_new", "971002", "KSA", "A"),
            (1, dt.datetime(2000, 1, 2), 0.02, 2, "fsn_new", "971002", "KSA", "A")]
    bu = select_business_unit(spark.createDataFrame(rows, TRX_SCHEMA), "KSA", as_of=AS_OF)
    r = kpi_mart(bu, SMALL_SPEC, money="cents").collect()[0]
    assert r["avg_a_1m"] == 2  # 1.5 cents rounds half up


def test_empty_input_gives_empty_frame_with_schema(spark):
    m = kpi_mart(_bu(spark, rows=[]), SMALL_SPEC)
    assert m.count() == 0
    assert m.columns == [C.CUSTOMER] + [c.name for c in SMALL_SPEC.cells()]


def test_date_typed_input(spark):
    bu = _bu(spark).withColumn(C.TRX_DATE, F.to_date(C.TRX_DATE))
    r = _by_key(kpi_mart(bu, SMALL_SPEC))
    # anchor 2000-03-31 as a date: bound 2000-02-29, both rows of customer 1 count
    assert r[1]["sum_a_1m"] == 30.0


def test_anchors_of_a_date_column_stay_dates(spark):
    bu = _bu(spark).withColumn(C.TRX_DATE, F.to_date(C.TRX_DATE))
    a = date_anchors(bu)
    types = dict(a.dtypes)
    assert types["max_date"] == "date" and types["days_ago_1"] == "date" and types["months_ago_1"] == "date"
    r = a.collect()[0]
    assert r["days_ago_1"] == dt.date(2000, 3, 30) and r["months_ago_1"] == dt.date(2000, 2, 29)


def test_brand_literals_with_quotes_and_backslashes(spark):
    from tallyspark.plans.spec import SUM, Brand, Family, KpiSpec
    odd = ["O'Brien (Store)", "Back\\slash", "Tick`s"]
    spec = KpiSpec((Family("s", None, ((SUM, "sum_{code}"),)),), tuple(Brand(b, f"b{i}") for i, b in enumerate(odd)))
    rows = [(1, dt.datetime(2000, 1, 1), float(i + 1), i, "fsn_new", "971002", "KSA", b) for i, b in enumerate(odd)]
    bu = select_business_unit(spark.createDataFrame(rows, TRX_SCHEMA), "KSA", as_of=AS_OF)
    r = kpi_mart(bu, spec).collect()[0]
    assert (r["sum_b0"], r["sum_b1"], r["sum_b2"]) == (1.0, 2.0, 3.0)


def test_decimal_amounts_stay_decimal_and_unrounded(spark):
    from decimal import Decimal

    from tallyspark.operators.quality import round_floats
    bu = _bu(spark).withColumn(C.AMOUNT, F.col(C.AMOUNT).cast("decimal(12,3)"))
    m = round_floats(kpi_mart(bu, SMALL_SPEC))
    types = dict(m.dtypes)
    assert types["sum_a_1m"].startswith("decimal") and types["avg_a_1m"].startswith("decimal")
    r = {row[C.CUSTOMER]: row for row in m.collect()}
    assert r[1]["sum_a_1m"] == Decimal("10.000")
    cents = {row[C.CUSTOMER]: row for row in kpi_mart(bu, SMALL_SPEC, money="cents").collect()}
    assert cents[1]["sum_a_1m"] == 1000


def test_business_unit_without_bu_columns(spark):
    trx = spark.createDataFrame(ROWS, TRX_SCHEMA).drop(C.BU, C.SOURCE_SYSTEM)
    bu = select_business_unit(trx, "KSA", as_of=AS_OF)
    assert C.BU not in bu.columns and kpi_mart(bu, SMALL_SPEC).count() == 8


def test_staged_and_unstaged_marts_are_equal(spark):
    bu = _bu(spark)
    plain = sorted(map(tuple, kpi_mart(bu, SMALL_SPEC, money="cents").collect()), key=str)
    staged = sorted(map(tuple, kpi_mart(bu, SMALL_SPEC, money="cents", stage=True).collect()), key=str)
    assert plain == staged and len(plain) == 7
