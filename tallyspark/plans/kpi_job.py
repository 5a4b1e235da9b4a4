"""The KPI job end to end: business-unit set -> mart -> rounding -> profile -> external-id publishing.

``build_kpi_outputs`` returns the lazy DataFrames.  ``run_kpi_job`` writes the
mart first and publishes from the written table, so the mart's aggregation
runs once and a lost executor during publishing re-reads files instead of
recomputing the mart.
"""

from __future__ import annotations

from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallyspark import columns as C
from tallyspark.operators.business_unit import select_business_unit
from tallyspark.operators.kpi import kpi_mart
from tallyspark.operators.publish import publish_external
from tallyspark.operators.quality import non_null_profile, round_floats
from tallyspark.plans.lifestyle_spec import (LIFESTYLE_BU, LIFESTYLE_COUNTRY, LIFESTYLE_ORG_CODE,
                                             LIFESTYLE_SOURCE_SYSTEM)
from tallyspark.plans.spec import KpiSpec
from tallyspark.sources.sinks import read_kpi, write_kpi
from tallyspark.sources.staging import staged_table

_USED = (C.CUSTOMER, C.TRX_DATE, C.AMOUNT, C.TXN_ID, C.BRAND)


@dataclass(frozen=True)
class KpiJobSettings:
    country: str | None = LIFESTYLE_COUNTRY
    bu: str | None = LIFESTYLE_BU
    source_system: str | None = LIFESTYLE_SOURCE_SYSTEM
    org_code: str | None = LIFESTYLE_ORG_CODE
    as_of: object = None          # None: current_date()
    money: str = "double"         # "cents" for exact integer cents
    round_scale: int = 2
    stage: bool = False           # True when the transactions are the result of joins


def build_kpi_outputs(trx: DataFrame, ext_map: DataFrame, spec: KpiSpec, settings: KpiJobSettings) -> dict:
    """``business_unit``, ``mart`` (rounded), ``profile`` and ``published`` as lazy DataFrames."""
    bu = select_business_unit(trx, settings.country, settings.bu, settings.source_system, settings.as_of)
    mart = round_floats(kpi_mart(bu, spec, money=settings.money, stage=settings.stage), settings.round_scale)
    return {
        "business_unit": bu,
        "mart": mart,
        "profile": non_null_profile(mart),
        "published": publish_external(mart, ext_map, settings.org_code),
    }


def run_kpi_job(trx: DataFrame, ext_map: DataFrame, spec: KpiSpec, settings: KpiJobSettings,
                mart_path: str, published_path: str | None = None, profile_path: str | None = None) -> dict:
    """Write the mart (overwrite), then profile and publish from the written table.

    Returns ``mart``, ``profile`` and ``published`` over the written data; the
    published rows and the profile are written too when their paths are given.  With
    ``settings.stage`` the staged business-unit rows are removed once the mart is there.
    """
    spark = trx.sparkSession
    bu = select_business_unit(trx, settings.country, settings.bu, settings.source_system, settings.as_of)
    with staged_table(bu.select(*_USED), "kpi-rows") if settings.stage else nullcontext(bu) as rows:
        built = round_floats(kpi_mart(rows, spec, money=settings.money), settings.round_scale)
        write_kpi(built, mart_path)
    mart = read_kpi(spark, mart_path)
    published = publish_external(mart, ext_map, settings.org_code)
    if published_path is not None:
        write_kpi(published, published_path)
        published = read_kpi(spark, published_path)
    profile = non_null_profile(mart)
    if profile_path is not None:
        write_kpi(profile, profile_path)
        profile = read_kpi(spark, profile_path)
    return {"mart": mart, "profile": profile, "published": published}
