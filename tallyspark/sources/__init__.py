"""Sources and sinks: table scans, the supplied-table views, SQL export, landing, KPI and audit sinks."""

from tallyspark.sources.export import export_sql, jdbc_extract
from tallyspark.sources.sinks import (append_audit, committed_runs, extract_to_landing, land_and_count, read_audit,
                                      read_kpi, read_landing, write_kpi)
from tallyspark.sources.staging import stage_table
from tallyspark.sources.tables import read_table, table_path

__all__ = ["read_table", "table_path", "export_sql", "jdbc_extract", "append_audit", "extract_to_landing",
           "read_audit", "read_kpi", "read_landing", "write_kpi", "stage_table", "land_and_count",
           "committed_runs"]
