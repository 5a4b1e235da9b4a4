"""Column-level helpers; all built from ``pyspark.sql.functions`` (JVM side, codegen'd)."""

from tallyspark.functions.dates import days_back, month_start_text, months_back
from tallyspark.functions.money import half_up_avg_cents_sql, to_cents
from tallyspark.functions.audit_text import AUDIT_TS_FORMAT, audit_ts_text, row_hash
from tallyspark.functions.frames import first_column

__all__ = [
    "months_back", "days_back", "month_start_text", "to_cents", "half_up_avg_cents_sql",
    "AUDIT_TS_FORMAT", "audit_ts_text", "row_hash", "first_column",
]
