import datetime as dt
import os

import pytest

from tallyspark import columns as C
from tallyspark.plans import LIFESTYLE_SPEC
from tallyspark.plans.kpi_job import KpiJobSettings, build_kpi_outputs, run_kpi_job
from tallyspark.session import checkpoint_root, discard_scratch, scratch_path
from tallyspark.sources.sinks import read_kpi

from fixtures import TRX_SCHEMA


def _trx(spark):
    t = dt.datetime
    rows = [
        (1, t(2000, 3, 1), 10.004, 1, "fsn_new", "971002", "KSA", "THAT (Store)"),
        (1, t(2000, 3, 2), 20.0, 2, "fsn_new", "971002", "KSA", "CB2 (Store)"),
        (2, t(2000, 3, 31), 5.0, 3, "fsn_new", "971002", "KSA", "THAT"),
        (3, t(2000, 3, 10), 7.0, 4, "other", "971002", "KSA", "THAT (Store)"),
    ]
    return spark.createDataFrame(rows, TRX_SCHEMA)


def _ext(spark):
    return spark.createDataFrame([("FSN", 1, "X1"), ("FSN", 2, "X2"), ("FSN", 3, "X3")],
                                 f"{C.ORG_CODE} string, {C.GCR_ID} bigint, {C.EXTERNAL_ID} string")


def test_reference_spec_on_its_own_brand_literals(spark):
    out = build_kpi_outputs(_trx(spark), _ext(spark), LIFESTYLE_SPEC, KpiJobSettings(as_of="2001-01-01"))
    mart = {r[C.CUSTOMER]: r.asDict() for r in out["mart"].collect()}
    assert set(mart) == {1, 2}  # customer 3 is another BU
    assert len(out["mart"].columns) == 89
    # "THAT (Store)" feeds the spend columns, the status flags read the literal "THAT"
    assert mart[1]["total_spend_lifestyle_that_last_3_months_ksa"] == 10.0  # rounded to 2 places
    assert mart[1]["lifestyle_that_status_active_ksa"] is None
    assert mart[1]["lifestyle_that_status_inactive_ksa"] is None
    assert mart[2]["lifestyle_that_status_active_ksa"] == 1
    assert mart[2]["total_spend_lifestyle_that_last_3_months_ksa"] is None
    assert mart[1]["lifestyle_cb2_status_active_ksa"] == 1
    profile = {r[C.PROFILE_COLUMN]: r[C.PROFILE_COUNT] for r in out["profile"].collect()}
    assert profile[C.CUSTOMER] == 2 and profile["total_transactions_lifestyle_cb2_lifetime_ksa"] == 1


def test_run_writes_mart_and_publishes_from_it(spark):
    root = scratch_path(spark, "t-kpi-job")
    out = run_kpi_job(_trx(spark), _ext(spark), LIFESTYLE_SPEC, KpiJobSettings(as_of="2001-01-01"),
                      f"{root}/mart", f"{root}/published")
    pub = out["published"]
    assert pub.columns[-2:] == [C.GCR_ID, C.CUSTOMER] and len(pub.columns) == 90
    assert sorted(r[C.CUSTOMER] for r in pub.collect()) == ["X1", "X2"]
    assert read_kpi(spark, f"{root}/mart").count() == 2


def test_staged_rows_are_removed_after_the_job(spark):
    kept = [os.path.join(checkpoint_root(spark), "tallyspark", name) for name in ("stage-kpi-rows", "kpi-next")]
    before = [set(os.listdir(f)) if os.path.isdir(f) else set() for f in kept]
    root = scratch_path(spark, "t-kpi-staged")
    out = run_kpi_job(_trx(spark), _ext(spark), LIFESTYLE_SPEC, KpiJobSettings(as_of="2001-01-01", stage=True),
                      f"{root}/mart", f"{root}/published", f"{root}/profile")
    assert sorted(r[C.CUSTOMER] for r in out["published"].collect()) == ["X1", "X2"]
    profile = {r[C.PROFILE_COLUMN]: r[C.PROFILE_COUNT] for r in read_kpi(spark, f"{root}/profile").collect()}
    assert profile[C.CUSTOMER] == 2
    there = [set(os.listdir(f)) if os.path.isdir(f) else set() for f in kept]  # the mart is written in place, not copied
    assert [f - b for f, b in zip(there, before)] == [set(), set()]


def test_only_scratch_folders_can_be_discarded(spark, tmp_path):
    with pytest.raises(ValueError):
        discard_scratch(spark, str(tmp_path))
