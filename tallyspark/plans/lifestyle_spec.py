"""The 88-column lifestyle KPI specification and its instance for the supplied tables."""

from __future__ import annotations

from tallyspark.plans.spec import ACTIVE, AVG, COUNT, INACTIVE, SUM, Brand, Family, KpiSpec

# ---------------------------------------------------------------------------
# These names and literals must equal the KPI job's own so that
# the produced table keeps its published column names.
#
# Families in column order (key, look-back months, outputs):
_AVG = "average_customer_spend_lifestyle_{code}_last_%d_months_ksa"
FAMILIES = (
    Family("avg_spend_6m", 6, ((AVG, _AVG % 6),)),
    Family("avg_spend_3m", 3, ((AVG, _AVG % 3),)),
    Family("avg_spend_1m", 1, ((AVG, _AVG % 1),)),
    Family("avg_spend_2m", 2, ((AVG, _AVG % 2),)),
    Family("total_spend_3m", 3, ((SUM, "total_spend_lifestyle_{code}_last_3_months_ksa"),)),
    Family("total_spend_6m", 6, ((SUM, "total_spend_lifestyle_{code}_last_6_months_ksa"),)),
    Family("total_spend_12m", 12, ((SUM, "total_spend_lifestyle_{code}_last_12_months_ksa"),)),
    Family("transactions_lifetime", None, ((COUNT, "total_transactions_lifestyle_{code}_lifetime_ksa"),)),
    Family("avg_transaction_value_12m", 12,
           ((AVG, "average_transaction_value_lifestyle_{code}_last_12_months_ksa"),)),
    Family("status_6m", 6, ((ACTIVE, "lifestyle_{code}_status_active_ksa"),
                            (INACTIVE, "lifestyle_{code}_status_inactive_ksa"))),
)

# Brand literals and their codes, in column order:
LIFESTYLE_BRANDS = (
    Brand("THAT (Store)", "that"),
    Brand("LuluLemon (Store)", "lll"),
    Brand("All Saints (Store)", "als"),
    Brand("Hollister (Store)", "hs"),
    Brand("Abercrombie and Fitch (Store)", "anb"),
    Brand("Crate & Barrel (Store)", "cnb"),
    Brand("CB2 (Store)", "cb2"),
    Brand("Fashion For Less (Store)", "ffl"),
)

# Column names that do not follow their template:
NAME_OVERRIDES = {
    ("avg_spend_3m", "ffl", AVG): "ffl_average_customer_spend_lifestyle_ffl_last_3_months_ksa",
    ("avg_spend_1m", "ffl", AVG): "ffl_average_customer_spend_lifestyle_ffl_last_1_months_ksa",
    ("avg_spend_2m", "ffl", AVG): "ffl_average_customer_spend_lifestyle_ffl_last_2_months_ksa",
}

# The status flags of "that" filter on the brand literal "THAT":
LIFESTYLE_BRAND_OVERRIDES = {("status_6m", "that"): "THAT"}

# Filters of the KPI job's business-unit set:
LIFESTYLE_COUNTRY = "KSA"
LIFESTYLE_BU = "fsn_new"
LIFESTYLE_SOURCE_SYSTEM = "971002"
LIFESTYLE_ORG_CODE = "FSN"
# ---------------------------------------------------------------------------

LIFESTYLE_SPEC = KpiSpec(FAMILIES, LIFESTYLE_BRANDS, dict(LIFESTYLE_BRAND_OVERRIDES), dict(NAME_OVERRIDES))


def supplied_tables_spec() -> KpiSpec:
    """The same families and names over the supplied part brands ``Brand#1`` .. ``Brand#8``.

    The codes of the lifestyle brands are kept so the column names are the
    published ones; no brand literal is overridden.
    """
    brands = [Brand(f"Brand#{i + 1}", b.code) for i, b in enumerate(LIFESTYLE_BRANDS)]
    return LIFESTYLE_SPEC.with_brands(brands)
