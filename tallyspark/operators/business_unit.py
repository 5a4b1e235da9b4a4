"""Selecting the business-unit set the KPIs are computed over (country, not future, BU, source system)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark import columns as C


def as_of_column(as_of=None) -> Column:
    """``current_date()`` when ``as_of`` is None, else the given date (``date`` or ``yyyy-MM-dd``)."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.strftime("%Y-%m-%d")
    return F.to_date(F.lit(str(as_of)))


def select_business_unit(trx: DataFrame, country: str | None, bu: str | None = None,
                         source_system: str | None = None, as_of=None) -> DataFrame:
    """Rows of one country dated no later than ``as_of``, optionally of one BU and source system.

    NULL and future dates drop out (``<=`` is not true for them).  A filter
    given as None is not applied (its column may then be absent).  The result
    keeps the transaction columns present among the eight conformed ones; every
    predicate is a plain comparison, so it reaches the scan.
    """
    cond = F.col(C.TRX_DATE) <= as_of_column(as_of)
    if country is not None:
        cond = cond & (F.col(C.COUNTRY) == F.lit(country))
    if bu is not None:
        cond = cond & (F.col(C.BU) == F.lit(bu))
    if source_system is not None:
        cond = cond & (F.col(C.SOURCE_SYSTEM) == F.lit(source_system))
    return trx.where(cond).select(*[c for c in C.TRANSACTION_COLUMNS if c in trx.columns])


def customer_keys(bu_rows: DataFrame, customer: str = C.CUSTOMER) -> DataFrame:
    """Distinct customers of the set (a NULL customer is kept as one row)."""
    return bu_rows.select(customer).distinct()
