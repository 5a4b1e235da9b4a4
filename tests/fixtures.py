"""Hand-written transaction rows for the rule tests (no supplied table has NULLs)."""

import datetime as dt

from tallyspark import columns as C
from tallyspark.plans.spec import ACTIVE, AVG, COUNT, INACTIVE, SUM, Brand, Family, KpiSpec

TRX_SCHEMA = (f"{C.CUSTOMER} bigint, {C.TRX_DATE} timestamp_ntz, {C.AMOUNT} double, {C.TXN_ID} bigint, "
              f"{C.BU} string, {C.SOURCE_SYSTEM} string, {C.COUNTRY} string, {C.BRAND} string")


def ts(s):
    return dt.datetime.fromisoformat(s)


def row(cust, when, amount, txn, brand, country="KSA", bu="fsn_new", sor="971002"):
    return (cust, None if when is None else ts(when), amount, txn, bu, sor, country, brand)


# The anchor is 2000-03-31 10:00 (latest in-set date, customer 6); one month back is 2000-02-29 10:00.
ROWS = [
    # 1: brand A inside 1m (exactly on the bound) and one hour before the bound
    row(1, "2000-02-29 10:00:00", 10.00, 100, "A"),
    row(1, "2000-02-29 09:00:00", 20.00, 101, "A"),
    # 2: brand A only outside every window; brand B inside
    row(2, "1999-01-01 00:00:00", 5.00, 200, "A"),
    row(2, "2000-03-30 00:00:00", 7.50, 201, "B"),
    # 3: NULL transaction ids for brand B
    row(3, "2000-03-01 00:00:00", 1.00, None, "B"),
    row(3, "2000-03-02 00:00:00", 2.00, None, "B"),
    # 4: only an unlisted brand
    row(4, "2000-03-15 00:00:00", 3.00, 400, "Z"),
    # NULL customer with a listed brand
    row(None, "2000-03-20 00:00:00", 9.00, 500, "A"),
    # 5: NULL date and a future date (both dropped), plus one valid row
    row(5, None, 99.00, 600, "A"),
    row(5, "2999-01-01 00:00:00", 99.00, 601, "A"),
    row(5, "2000-03-10 00:00:00", 4.00, 602, "A"),
    # 6: holds the anchor; other country and other BU rows are out of the set
    row(6, "2000-03-31 10:00:00", 6.00, 700, "B"),
    row(6, "2000-04-30 00:00:00", 1000.00, 701, "A", country="UAE"),
    row(7, "2000-03-05 00:00:00", 1000.00, 800, "A", bu="other"),
]

AS_OF = "2001-01-01"

SMALL_SPEC = KpiSpec(
    families=(
        Family("sum1", 1, ((SUM, "sum_{code}_1m"),)),
        Family("avg1", 1, ((AVG, "avg_{code}_1m"),)),
        Family("cnt", None, ((COUNT, "cnt_{code}_life"),)),
        Family("status1", 1, ((ACTIVE, "active_{code}"), (INACTIVE, "inactive_{code}"))),
    ),
    brands=(Brand("A", "a"), Brand("B", "b")),
)
