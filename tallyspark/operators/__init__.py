"""DataFrame -> DataFrame operators; all lazy, none collects."""

from tallyspark.operators.anchors import date_anchors, window_bounds
from tallyspark.operators.audit import (FAILED, SUCCEEDED, CountSource, audit_rows, audit_summary,
                                        load_status, table_count_audit)
from tallyspark.operators.business_unit import customer_keys, select_business_unit
from tallyspark.operators.increments import discover_increments, increment_dates, increment_dates_sql
from tallyspark.operators.kpi import kpi_mart
from tallyspark.operators.publish import external_pairs, publish_external
from tallyspark.operators.quality import non_null_profile, round_floats
from tallyspark.operators.reconcile import daily_counts, reconcile, reconcile_source_dates

__all__ = [
    "date_anchors", "window_bounds", "FAILED", "SUCCEEDED", "CountSource", "audit_rows", "audit_summary",
    "load_status", "table_count_audit", "customer_keys", "select_business_unit", "discover_increments",
    "increment_dates", "increment_dates_sql", "kpi_mart", "external_pairs", "publish_external",
    "non_null_profile", "round_floats", "daily_counts", "reconcile", "reconcile_source_dates",
]
