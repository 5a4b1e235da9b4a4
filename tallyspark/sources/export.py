"""Export by SQL text and the extract reader.

``export_sql`` runs a stored SQL text with Spark SQL, verbatim but for the names
of the given tables: ``{name}`` stands for the DataFrame passed under that name;
any other brace is ordinary text.  ``jdbc_extract`` reads a warehouse table in parallel ranges of a
numeric column; it needs a reachable database and is not exercised offline.

``balanced_ranges`` cuts a table into ranges of about equal numbers of rows, however its
key is distributed, as a list of SQL predicates: for ``spark.read.jdbc(predicates=...)`` or,
on any other source, for one filtered read per range.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def export_sql(spark: SparkSession, sql_text: str, **frames: DataFrame) -> DataFrame:
    """Result of ``sql_text`` (lazy).  Each frame becomes a temporary view of a unique name."""
    for name, frame in frames.items():
        view = f"export_{name}_{uuid.uuid4().hex}"
        frame.createOrReplaceTempView(view)
        sql_text = sql_text.replace("{" + name + "}", view)
    return spark.sql(sql_text)


def jdbc_extract(spark: SparkSession, url: str, table: str, partition_column: str, lower_bound: int,
                 upper_bound: int, num_partitions: int, properties: dict | None = None) -> DataFrame:
    """Parallel JDBC read: ``num_partitions`` range queries on ``partition_column``."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                           upperBound=upper_bound, numPartitions=num_partitions,
                           properties=properties or {})


def balanced_ranges(keys: DataFrame, column: str, ranges: int, spread: str | None = None,
                    accuracy: int = 100) -> list[str]:
    """Predicates that hold every row of ``keys`` exactly once, in ranges of about equal numbers of rows.

    The bounds are quantiles of the whole-number ``column`` (``percentile_approx``, partial in every task; its
    relative error is 1 / (``ranges`` * ``accuracy``) of the rows), not equal widths, so a skewed key does not fill one range.
    A key with more rows than a range should have gets ranges of its own; with a whole-number
    ``spread`` column these are split further by its remainder, which a table dominated by one key needs.
    Rows without a key have a predicate of their own.  Some ``4 * ranges`` numbers reach the driver.
    """
    if ranges < 1:
        raise ValueError("ranges must be at least 1")
    key = F.col(column)
    steps = 2 * ranges
    points = [k / steps for k in range(1, steps)]
    row = keys.agg(F.count(key).alias("n"), F.count(F.when(key.isNull(), 1)).alias("nulls"),
                   F.percentile_approx(key, points, steps * accuracy).alias("at")).first()
    out = [f"{column} IS NULL"] if row["nulls"] else []
    if not row["n"]:
        return out
    at = [int(a) for a in row["at"]]
    # a key that is the quantile twice or more holds over a part of the rows that a range should have
    heavy = sorted({a for a, b in zip(at, at[1:]) if a == b})
    found = keys.where(key.isin(heavy)).groupBy(key.alias("k")).agg(F.count("*").alias("n")).collect() if heavy else []
    most = row["n"] / ranges
    split = {r["k"]: -(-r["n"] // most) for r in found if r["n"] > most / 2}
    bounds, since = [], 0.0
    for a in at:  # every second step ends a range, counted anew after a heavy key
        since += 0.5
        if a in split:
            since = 0.0
        elif since >= 1 and (not bounds or a > bounds[-1]):
            bounds.append(a)
            since = 0.0
    cuts = sorted({b for b in bounds} | {k - 1 for k in split} | set(split))
    for low, high in zip([None, *cuts], [*cuts, None]):
        if high in split and low == high - 1:
            parts = int(split[high]) if spread else 1
            if parts == 1:
                out.append(f"{column} = {high}")
                continue
            rest = f"MOD(MOD({spread}, {parts}) + {parts}, {parts})"
            out += [f"{column} = {high} AND {rest} = {j}" for j in range(parts)]
            out.append(f"{column} = {high} AND {spread} IS NULL")
        else:
            sides = [f"{column} > {low}"] * (low is not None) + [f"{column} <= {high}"] * (high is not None)
            out.append(" AND ".join(sides) or f"{column} IS NOT NULL")
    return out


def extract_ranges(source: DataFrame, predicates: list[str]) -> DataFrame:
    """The rows of all ranges, with the number of their range as ``extract_range``.

    One pass over the source: a row's range is the first predicate that holds for it.
    """
    number = F.lit(None).cast("int")
    for i in reversed(range(len(predicates))):
        number = F.when(F.expr(predicates[i]), F.lit(i)).otherwise(number)
    return source.withColumn("extract_range", number)


def jdbc_extract_balanced(spark: SparkSession, url: str, table: str, partition_column: str, ranges: int,
                          properties: dict | None = None, spread: str | None = None) -> DataFrame:
    """Parallel JDBC read of one query per balanced range; the key column is read once more to find the bounds."""
    columns = ", ".join(dict.fromkeys(c for c in (partition_column, spread) if c))
    keys = spark.read.jdbc(url, f"(SELECT {columns} FROM {table}) keys", properties=properties or {})
    return spark.read.jdbc(url, table, predicates=balanced_ranges(keys, partition_column, ranges, spread),
                           properties=properties or {})
