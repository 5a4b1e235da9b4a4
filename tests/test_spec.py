from tallyspark.plans import LIFESTYLE_SPEC, supplied_tables_spec
from tallyspark.plans.spec import AVG, SUM, Brand, Family, KpiSpec


def test_lifestyle_spec_has_88_unique_columns():
    cells = LIFESTYLE_SPEC.cells()
    assert len(cells) == 88
    assert len({c.name for c in cells}) == 88


def test_lifestyle_spec_irregular_names_and_that_flag():
    names = [c.name for c in LIFESTYLE_SPEC.cells()]
    assert "ffl_average_customer_spend_lifestyle_ffl_last_3_months_ksa" in names
    assert "average_customer_spend_lifestyle_ffl_last_6_months_ksa" in names
    flags = {c.name: c.brand_literal for c in LIFESTYLE_SPEC.cells() if c.measure in ("active", "inactive")}
    assert flags["lifestyle_that_status_active_ksa"] == "THAT"
    assert flags["lifestyle_lll_status_inactive_ksa"] == "LuluLemon (Store)"
    # status columns interleave per brand
    assert names[-16:-14] == ["lifestyle_that_status_active_ksa", "lifestyle_that_status_inactive_ksa"]


def test_supplied_spec_keeps_names_without_brand_override():
    spec = supplied_tables_spec()
    assert [c.name for c in spec.cells()] == [c.name for c in LIFESTYLE_SPEC.cells()]
    assert spec.brand_literals() == [f"Brand#{i}" for i in range(1, 9)]
    assert spec.windows() == [1, 2, 3, 6, 12]


def test_select_and_duplicate_names():
    assert len(LIFESTYLE_SPEC.select(measures={SUM}).cells()) == 24
    dup = KpiSpec((Family("f", 1, ((AVG, "x"),)),), (Brand("A", "a"), Brand("B", "b")))
    try:
        dup.cells()
    except ValueError:
        return
    raise AssertionError("duplicate names must be rejected")


def test_spec_round_trips_through_json():
    import json
    doc = json.loads(json.dumps(LIFESTYLE_SPEC.to_dict()))
    again = KpiSpec.from_dict(doc)
    assert [(c.name, c.measure, c.months, c.brand_literal) for c in again.cells()] == \
           [(c.name, c.measure, c.months, c.brand_literal) for c in LIFESTYLE_SPEC.cells()]


def test_cluster_settings_scale_with_the_shuffle():
    from tallyspark.session import cluster_settings
    small, big = cluster_settings(10 * 1024 ** 2), cluster_settings(6 * 1024 ** 4)
    assert small["spark.sql.shuffle.partitions"] == "1"
    assert cluster_settings(100 * 10 ** 12)["spark.sql.shuffle.partitions"] == "745059"  # no cap
    assert int(big["spark.sql.shuffle.partitions"]) == 49152
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "128m"
