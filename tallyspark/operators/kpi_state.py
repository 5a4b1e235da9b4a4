"""The customer KPI mart kept up to date day by day, from sums that can be added and taken back.

Two tables under the state's path:

* ``days/as_of=<run>/day=<day>/``: what the rows read by a run add up to per customer, brand and
  date (cents, counts of amounts, rows and transactions), for the days of the longest window (older
  ones can't leave a window any more);
* ``totals`` (a versioned table): per customer and brand the same sums over each look-back window and
  over all time, and the latest date.  Its notes hold the as-of date and the anchor
  (the latest date so far) that the windows were cut at.

A run reads only the rows since the last one.  Sums of the new dates are added to
every window that they lie in, and days that the windows' lower bounds have moved past are read
back from ``days`` (by folder) and taken off: one aggregation of the old totals, the new sums and the
negated old days, without a join.  Late rows (older than the anchor) are added the
same way if the caller hands them in.  The mart is the second stage of ``kpi_mart`` over the totals.

Money is in whole cents, as sums are taken back exactly; doubles would drift.
Every output equals ``kpi_mart(..., money="cents")`` over all rows so far.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import columns as C
from tallyspark.functions.dates import months_back
from tallyspark.functions.money import half_up_avg_cents_sql, to_cents
from tallyspark.operators.kpi import BRAND_KEY, _ident, _sql_string
from tallyspark.plans.spec import ACTIVE, AVG, COUNT, INACTIVE, SUM, KpiSpec
from tallyspark.sources.files import Files
from tallyspark.sources.versions import current_version, read_table_version, replace_table

_SUMS = ("cents", "amounts", "rows", "txns")
#: Files that the sums of one day are written to, at most (more for a large chain).
FILES_A_DAY = 4
_LAST, _DATE, _DAY = "_last", "_date", "day"


def _total(name: str, months: int | None) -> str:
    return f"_{name}_{'life' if months is None else months}"


def state_as_of(spark: SparkSession, path: str) -> str | None:
    """The as-of date of the last finished run (yyyy-MM-dd), or None before the first."""
    now = current_version(spark, f"{path}/totals")
    return now["notes"]["as_of"] if now else None


def rows_since(bu_rows: DataFrame, last: str | None, as_of, date: str = C.TRX_DATE) -> DataFrame:
    """The rows dated after ``last`` and up to ``as_of``: plain comparisons, which reach the scan."""
    out = bu_rows.where(F.col(date) <= F.to_date(F.lit(_text(as_of))))
    return out if last is None else out.where(F.col(date) > F.to_date(F.lit(last)))


def _text(day) -> str:
    return day.strftime("%Y-%m-%d") if isinstance(day, (_dt.date, _dt.datetime)) else str(day)


def _per_date(rows: DataFrame, spec: KpiSpec, customer, date, amount, txn_id, brand) -> DataFrame:
    key = F.when(F.col(customer).isNotNull() & F.col(brand).isin(spec.brand_literals()), F.col(brand))
    listed = F.col(BRAND_KEY).isNotNull()
    cents = F.when(listed, to_cents(F.col(amount)))
    return (rows.withColumn(BRAND_KEY, key)
            .groupBy(F.col(customer).alias(C.CUSTOMER), BRAND_KEY, F.col(date).alias(_DATE))
            .agg(F.coalesce(F.sum(cents), F.lit(0)).alias("cents"), F.count(cents).alias("amounts"),
                 F.count(F.when(listed, 1)).alias("rows"), F.count(F.when(listed, F.col(txn_id))).alias("txns")))


def _bound(anchor: str, kind: str, months: int):
    return months_back(F.lit(anchor).cast(kind), months)


def _contribution(days: DataFrame, sign: int, inside: dict) -> DataFrame:
    """Each day's sums for the windows it counts in: ``inside[months]`` is a condition (None: all time)."""
    out = [F.col(C.CUSTOMER), F.col(BRAND_KEY), F.col(_DATE).alias(_LAST)]
    for months, cond in inside.items():
        for name in _SUMS:
            value = F.col(name) * F.lit(sign)
            out.append((value if cond is True else F.when(cond, value).otherwise(F.lit(0))).cast("bigint").alias(_total(name, months)))
    return days.select(*out)


def advance_mart(new_rows: DataFrame, path: str, spec: KpiSpec, as_of, customer: str = C.CUSTOMER,
                 date: str = C.TRX_DATE, amount: str = C.AMOUNT, txn_id: str = C.TXN_ID,
                 brand: str = C.BRAND) -> DataFrame:
    """Take in the rows since the last run (``rows_since``) and return the mart as of ``as_of``.

    A run for a day that the state has reached already changes nothing and returns the
    mart as it stands.  A run that broke off is simply repeated: its days are
    written over, and the totals switch in one step at the end.
    """
    spark = new_rows.sparkSession
    day, totals = _text(as_of), f"{path}/totals"
    before = current_version(spark, totals)
    windows = [None, *spec.windows()]
    if before is not None:
        notes = before["notes"]
        if notes["windows"] != windows or notes["brands"] != spec.brand_literals():
            raise ValueError("the state was built for other windows or brands")
        if day <= notes["as_of"]:
            return _mart(read_table_version(spark, totals), notes, spec, customer)
    kind = new_rows.schema[date].dataType.simpleString()
    fresh = _per_date(new_rows, spec, customer, date, amount, txn_id, brand)
    fresh.write.mode("overwrite").parquet(f"{path}/fresh")
    fresh = spark.read.schema(fresh.schema).parquet(f"{path}/fresh")
    latest = fresh.agg(F.max(_DATE).cast("string")).first()[0]
    old_anchor = before["notes"]["anchor"] if before else None
    anchor = max(a for a in (latest, old_anchor, "") if a is not None) or None
    notes = {"as_of": day, "anchor": anchor, "kind": kind, "windows": windows, "brands": spec.brand_literals()}
    spans = [m for m in windows if m is not None]

    def since(months):
        return F.col(_DATE) >= _bound(anchor, kind, months) if anchor else F.lit(False)

    if spans and anchor:
        days = fresh.where(since(max(spans))).withColumn(_DAY, F.to_date(_DATE))
        # a day's rows go to a few files, however many tasks there are
        days.repartition(_DAY, F.pmod(F.xxhash64(C.CUSTOMER), F.lit(FILES_A_DAY))).write.mode(
            "overwrite").partitionBy(_DAY).parquet(f"{path}/days/as_of={day}")
    # the plan of the new totals: added, and taken back
    parts = [_contribution(fresh, 1, {None: True} | {m: since(m) for m in spans})]
    if before is not None:
        held = read_table_version(spark, totals)
        parts.append(held)
        if old_anchor is not None and anchor != old_anchor:
            left = _left_windows(spark, path, before["notes"], notes, fresh)
            if left is not None:
                # only rows of the runs before: the new rows were never in a window that they are too old for
                out = {m: (F.col(_DATE) >= _bound(old_anchor, kind, m)) & (F.col(_DATE) < _bound(anchor, kind, m))
                       for m in spans}
                parts.append(_contribution(left, -1, {None: F.lit(False)} | out).withColumn(_LAST, F.lit(None).cast(kind)))
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    sums = [F.sum(c).alias(c) for c in (_total(n, m) for m in windows for n in _SUMS)]
    merged = union.groupBy(C.CUSTOMER, BRAND_KEY).agg(F.max(_LAST).alias(_LAST), *sums)
    replace_table(merged, totals, notes, based_on=before and before["version"])
    Files(spark, path).delete(f"{path}/fresh")
    return _mart(read_table_version(spark, totals), notes, spec, customer)


def _left_windows(spark: SparkSession, path: str, old: dict, new: dict, like: DataFrame) -> DataFrame | None:
    """The days of earlier runs that some window's lower bound has moved past; only their folders are read."""
    names = Files(spark, f"{path}/days").names(f"{path}/days")
    runs = [n for n in names if n.startswith("as_of=") and n[6:] <= old["as_of"]]
    if not runs:
        return None
    spans = [m for m in old["windows"] if m is not None]
    row = spark.range(1).select(*[F.to_date(_bound(x["anchor"], new["kind"], m)).cast("string").alias(f"{k}{m}")
                                  for k, x in (("a", old), ("b", new)) for m in spans]).first()
    ranges = [(row[f"a{m}"], row[f"b{m}"]) for m in spans]
    schema = like.schema.add(_DAY, "date")
    days = spark.read.schema(schema).option("basePath", f"{path}/days").parquet(*[f"{path}/days/{r}" for r in runs])
    moved = F.lit(False)
    for low, high in ranges:  # whole days by folder; the exact times are compared afterwards
        moved = moved | F.col(_DAY).between(F.to_date(F.lit(low)), F.to_date(F.lit(high)))
    return days.where(moved).drop(_DAY, "as_of")


def _mart(totals: DataFrame, notes: dict, spec: KpiSpec, customer: str) -> DataFrame:
    """The wide mart: per customer and brand the KPI of each window, then one row per customer."""
    def sql(name, months):
        return _ident(_total(name, months))

    exprs = {}
    for cell in spec.cells():
        m, bought = cell.months, f"{sql('rows', None)} > 0"
        if cell.measure == SUM:
            value = f"CASE WHEN {sql('amounts', m)} > 0 THEN {sql('cents', m)} END"
        elif cell.measure == AVG:
            value = half_up_avg_cents_sql(sql("cents", m), sql("amounts", m))
        elif cell.measure == COUNT:
            value = f"CASE WHEN {sql('rows', m)} > 0 THEN {sql('txns', m)} END"
        elif cell.measure == ACTIVE:
            value = f"CASE WHEN {sql('rows', m)} > 0 THEN 1 END"
        elif cell.measure == INACTIVE:
            value = f"CASE WHEN {bought} AND {sql('rows', m)} = 0 THEN 1 END"
        else:  # pragma: no cover - guarded by Family
            raise ValueError(cell.measure)
        exprs[cell.name] = (f"max(CASE WHEN {_ident(BRAND_KEY)} = {_sql_string(cell.brand_literal)} THEN {value} END) "
                            f"AS {_ident(cell.name)}")
    return totals.groupBy(F.col(C.CUSTOMER).alias(customer)).agg(*[F.expr(e) for e in exprs.values()])
