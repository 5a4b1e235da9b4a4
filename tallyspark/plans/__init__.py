"""KPI specifications and the registered query catalogue."""

from tallyspark.plans.spec import (ACTIVE, AVG, COUNT, INACTIVE, SUM, Brand, Cell, Family,
                                   KpiSpec)
from tallyspark.plans.lifestyle_spec import LIFESTYLE_SPEC, supplied_tables_spec

__all__ = ["SUM", "AVG", "COUNT", "ACTIVE", "INACTIVE", "Brand", "Cell", "Family", "KpiSpec",
           "LIFESTYLE_SPEC", "supplied_tables_spec"]
