"""Roles of the KPI and audit jobs mapped onto the supplied star-schema tables.

* transactions: one row per line item; customer = order's customer, date =
  order date, amount = extended price, transaction id = order key, brand = part
  brand, country = region name of the customer's nation, business unit =
  return flag, source system = line status.
* external id map: built from the customer table: ``gcr_id`` = customer key,
  ``org_code`` = market segment, ``external_id`` = ``EXT-<key div 3>`` (so
  neighbouring customers share one id), plus a second id ``ALT-<key>`` for
  customers with a negative balance (so some customers have two ids).
* load audit: the source is the events table, its incremental column the event
  date; the target is the loaded copy, i.e. the events that are not errors.

Join strategy is left to the planner: it broadcasts a side only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (statically
from file sizes, or at run time through AQE) and shuffles both sides otherwise,
so the dimension joins stay correct when customer or part no longer fit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import columns as C
from tallyspark.sources import tables as _tables

# Declared schemas of the supplied tables (no footer-inference job per read).
SCHEMAS = {
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
             "p_retailprice double"),
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return _tables.read_table(spark, base, name, schema=SCHEMAS.get(name))


def transactions(spark: SparkSession, base: str, amount: str = "l_extendedprice") -> DataFrame:
    """The transactions fact over the supplied tables, with the conformed column names; ``amount`` is a line column."""
    line = read_table(spark, base, "lineitem").select(
        "l_orderkey", "l_partkey", amount, "l_returnflag", "l_linestatus")
    orders = read_table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = read_table(spark, base, "part").select("p_partkey", "p_brand")
    customer = read_table(spark, base, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, base, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, base, "region").select("r_regionkey", "r_name")

    # Join order: the customer's region first (orders x customers in the region), so a country
    # filter shrinks the orders before the line items are joined; the line items are the largest
    # input and are joined once, then the part brand.
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    cust_geo = customer.join(geo, customer.c_nationkey == geo.n_nationkey).select("c_custkey", "r_name")
    orders_geo = orders.join(cust_geo, orders.o_custkey == cust_geo.c_custkey)
    return (
        line.join(orders_geo, line.l_orderkey == orders_geo.o_orderkey)
        .join(part, line.l_partkey == part.p_partkey)
        .select(
            F.col("o_custkey").alias(C.CUSTOMER),
            F.col("o_orderdate").alias(C.TRX_DATE),
            F.col(amount).alias(C.AMOUNT),
            F.col("l_orderkey").alias(C.TXN_ID),
            F.col("l_returnflag").alias(C.BU),
            F.col("l_linestatus").alias(C.SOURCE_SYSTEM),
            F.col("r_name").alias(C.COUNTRY),
            F.col("p_brand").alias(C.BRAND),
        )
    )


def external_id_map(spark: SparkSession, base: str) -> DataFrame:
    """``(org_code, gcr_id, external_id)`` derived from the customer table."""
    customer = read_table(spark, base, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    shared = customer.select(
        F.col("c_mktsegment").alias(C.ORG_CODE),
        F.col("c_custkey").alias(C.GCR_ID),
        F.concat(F.lit("EXT-"), F.call_function("div", F.col("c_custkey"), F.lit(3)).cast("string"))
        .alias(C.EXTERNAL_ID),
    )
    second = customer.where(F.col("c_acctbal") < 0).select(
        F.col("c_mktsegment").alias(C.ORG_CODE),
        F.col("c_custkey").alias(C.GCR_ID),
        F.concat(F.lit("ALT-"), F.col("c_custkey").cast("string")).alias(C.EXTERNAL_ID),
    )
    return shared.unionByName(second)


EVENT_DATE = "event_date"


def audit_source(spark: SparkSession, base: str) -> DataFrame:
    """Source of the load audit: events with their date as the incremental column."""
    return read_table(spark, base, "events").withColumn(EVENT_DATE, F.to_date("ts"))


def audit_target(spark: SparkSession, base: str) -> DataFrame:
    """Target of the load audit: the loaded events (errors are not loaded)."""
    return audit_source(spark, base).where(F.col("event_type") != F.lit("error"))


def active_source(spark: SparkSession, base: str) -> DataFrame:
    """The source restricted to its active rows (every event type but errors and signups)."""
    return audit_source(spark, base).where(~F.col("event_type").isin("error", "signup"))
