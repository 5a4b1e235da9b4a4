"""Publishing the KPI rows under an external id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark import columns as C

_WIN_ID = "_winner_external_id"
_WIN_GCR = "_winner_gcr_id"


def external_pairs(ext_map: DataFrame, org_code: str | None) -> DataFrame:
    """Distinct ``(gcr_id, external_id)`` pairs of one organisation (all when ``org_code`` is None)."""
    if org_code is not None:
        ext_map = ext_map.where(F.col(C.ORG_CODE) == F.lit(org_code))
    return ext_map.select(C.GCR_ID, C.EXTERNAL_ID).distinct()


def publish_external(kpis: DataFrame, ext_map: DataFrame, org_code: str | None,
                     key: str = C.CUSTOMER) -> DataFrame:
    """KPI rows re-keyed to the external id: ``<kpi columns>, gcr_id, <key>`` (``key`` holds the external id).

    Inner join on ``key = gcr_id`` (customers without an id drop out, a customer
    with several ids fans out), then one row per external id: the row with the
    smallest ``gcr_id`` wins.  The winner is found on the narrow pairs with a
    ``min`` aggregate (map-side partial, so an id shared by a huge number of
    customers never becomes one task's group) and kept by a semi join on the
    unique ``(external_id, gcr_id)`` pair, so no wide row is sorted or grouped.
    """
    pairs = external_pairs(ext_map, org_code)
    kpi_cols = [c for c in kpis.columns if c != key]
    joined = kpis.join(pairs, kpis[key] == pairs[C.GCR_ID], "inner").drop(key)
    winners = joined.groupBy(F.col(C.EXTERNAL_ID).alias(_WIN_ID)).agg(F.min(C.GCR_ID).alias(_WIN_GCR))
    kept = joined.join(winners, joined[C.EXTERNAL_ID].eqNullSafe(winners[_WIN_ID])
                       & (joined[C.GCR_ID] == winners[_WIN_GCR]), "left_semi")
    return kept.select(*kpi_cols, C.GCR_ID, F.col(C.EXTERNAL_ID).alias(key))
