"""The customer KPI mart: one wide row of brand x look-back KPIs per customer.

Plan shape (for any specification):

1. ``bounds``: one scalar subquery over the same rows, the maximum date and its
   month offsets (global aggregate, partial per task).
2. Stage one: ``groupBy(customer, brand_key)`` where ``brand_key`` is the brand
   when it is a listed literal and the customer is not NULL, else NULL.  Every
   (measure, window) pair the specification needs is one conditional aggregate
   (``sum``/``avg``/``count``/``max`` over ``when(date >= bound, ...)``).  The
   map side pre-aggregates, so a customer holding a third of all rows still
   ships at most one partial row per task and brand.
3. Stage two: ``groupBy(customer)``, one ``max(when(brand_key = literal, x))``
   per output column (a pivot over at most one row per brand).

Per-row work happens once in a projection before stage one: the brand key, the
amount (or its cents) and one boolean per window.  Aggregates are given as SQL
expression text, which keeps the driver's plan building cheap for wide specs.

Customers without any listed brand survive through their NULL ``brand_key``
group and get NULL KPIs; a NULL customer gets one all-NULL row.  This replaces
the per-column filter / aggregate / left-join chain with two shuffles of
pre-aggregated rows and no join at all.

Rules kept from the KPI job:
* a customer without rows for (brand, window) gets NULL, never 0;
* the lifetime count counts non-null transaction ids (not distinct); it is NULL
  when the customer never bought the brand and may be 0 otherwise;
* the window's lower bound is inclusive, there is no upper bound;
* ``active`` is 1 when the brand's latest purchase is inside the window,
  ``inactive`` is 1 when it is not; both are NULL for a brand never bought;
* averages are per transaction row (``avg(amount)``), not per visit.

``money="double"`` keeps amounts as doubles (the job's behaviour; round with
``round_floats`` afterwards).  ``money="cents"`` returns sums and averages as
exact bigint cents, averages rounded half away from zero, so two engines agree
to the cent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark import columns as C
from tallyspark.functions.money import half_up_avg_cents_sql, to_cents
from tallyspark.operators.anchors import months_col, window_bounds
from tallyspark.plans.spec import ACTIVE, AVG, COUNT, INACTIVE, SUM, KpiSpec
from tallyspark.sources.staging import stage_table

BRAND_KEY = "_brand_key"
BOUNDS = "_bounds"
VALUE = "_value"
TXN = "_txn"
MONEY_FORMS = ("double", "cents")


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sql_string(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _window_flag(months: int) -> str:
    return f"_in_{months}m"


def _measure_name(measure: str, months: int | None) -> str:
    return f"_{measure}_{'life' if months is None else months}"


def kpi_mart(bu_rows: DataFrame, spec: KpiSpec, money: str = "double",
             customer: str = C.CUSTOMER, date: str = C.TRX_DATE, amount: str = C.AMOUNT,
             txn_id: str = C.TXN_ID, brand: str = C.BRAND, stage: bool = False) -> DataFrame:
    """``customer`` plus one column per cell of ``spec``, one row per distinct customer of ``bu_rows``.

    ``bu_rows`` is the already filtered business-unit set (see
    ``select_business_unit``): it defines both the population and the anchor.

    ``stage=True`` first writes the five used columns of ``bu_rows`` once to the
    shared folder (an eager write) and runs the anchor and the aggregation from
    that table.  Use it when ``bu_rows`` is itself the result of joins; for a
    stored transactions table leave it off (the anchor pass then reads only
    the date column of the scan).
    """
    if money not in MONEY_FORMS:
        raise ValueError(f"money must be one of {MONEY_FORMS}")
    cells = spec.cells()
    rows = bu_rows.select(customer, date, amount, txn_id, brand)
    if stage:
        rows = stage_table(rows, "kpi-rows")
    # one reference to the bounds subquery; every window reads a field of it
    rows = rows.withColumn(BOUNDS, window_bounds(rows, spec.windows(), date))

    # per-row values computed once: the amount (or its cents), the brand key, one flag per window
    value = to_cents(F.col(amount)) if money == "cents" else F.col(amount)
    brand_key = F.when(F.col(customer).isNotNull() & F.col(brand).isin(spec.brand_literals()),
                       F.col(brand))
    keyed = rows.withColumn(BRAND_KEY, brand_key)
    # rows of unlisted brands only count towards the population: their measures are
    # never read in stage two, so they carry NULLs and cost the aggregates nothing
    listed = F.col(BRAND_KEY).isNotNull()
    pre = keyed.select(
        F.col(customer), F.col(BRAND_KEY), F.when(listed, F.col(txn_id)).alias(TXN),
        F.when(listed, value).alias(VALUE),
        *[(listed & (F.col(date) >= F.col(BOUNDS).getField(months_col(m)))).alias(_window_flag(m))
          for m in spec.windows()])

    # aggregates as SQL expression text over the projected columns (one parse per
    # expression instead of a chain of Column calls through the driver gateway)
    val, txn = _ident(VALUE), _ident(TXN)

    def when_in(months: int | None, expr: str) -> str:
        return expr if months is None else f"CASE WHEN {_ident(_window_flag(months))} THEN {expr} END"

    stage1_exprs: dict[str, str] = {}
    for cell in cells:
        key = _measure_name(cell.measure, cell.months)
        if key in stage1_exprs:
            continue
        m = cell.months
        any_in = f"max({when_in(m, '1')})"
        if cell.measure == SUM:
            expr = f"sum({when_in(m, val)})"
        elif cell.measure == AVG:
            if money == "cents":
                expr = half_up_avg_cents_sql(f"sum({when_in(m, val)})", f"count({when_in(m, val)})")
            else:
                expr = f"avg({when_in(m, val)})"
        elif cell.measure == COUNT:
            expr = f"count({txn})" if m is None else \
                f"CASE WHEN {any_in} IS NOT NULL THEN count({when_in(m, txn)}) END"
        elif cell.measure == ACTIVE:
            expr = any_in
        elif cell.measure == INACTIVE:
            expr = f"CASE WHEN {any_in} IS NULL THEN 1 END"
        else:  # pragma: no cover - guarded by Family
            raise ValueError(cell.measure)
        stage1_exprs[key] = f"{expr} AS {_ident(key)}"

    stage1 = pre.groupBy(customer, BRAND_KEY).agg(*[F.expr(e) for e in stage1_exprs.values()])

    # stage two as SQL expression text: one parse per column instead of a chain of
    # Column calls (the 88-column pivot would otherwise cost thousands of driver round trips)
    stage2_exprs = [
        F.expr(f"max(CASE WHEN {_ident(BRAND_KEY)} = {_sql_string(cell.brand_literal)} "
               f"THEN {_ident(_measure_name(cell.measure, cell.months))} END) AS {_ident(cell.name)}")
        for cell in cells
    ]
    return stage1.groupBy(customer).agg(*stage2_exprs)
