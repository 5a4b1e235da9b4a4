"""Table scans (latest snapshot of a table by path)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table_path(base: str, name: str, fmt: str = "parquet") -> str:
    """``<base>/<name>.parquet`` for parquet tables stored as one file or folder, else ``<base>/<name>``."""
    if fmt == "parquet":
        return os.path.join(base, f"{name}.parquet")
    return os.path.join(base, name)


def read_table(spark: SparkSession, base: str, name: str, fmt: str = "parquet",
               schema: str | None = None) -> DataFrame:
    """Scan a table.  Parquet by default; ``fmt="delta"`` needs the Delta jar on the classpath.

    The scan is lazy: later ``select``/``where`` calls are pruned and pushed into
    it by Catalyst (``ReadSchema`` / ``PushedFilters`` in the plan).  A declared
    ``schema`` (DDL text) skips the job that infers it from file footers.
    """
    path = table_path(base, name, fmt)
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "parquet":
        return reader.parquet(path)
    return reader.format(fmt).load(path)
