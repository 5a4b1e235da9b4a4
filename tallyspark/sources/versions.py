"""Tables that are replaced as a whole, without a moment in which there is none.

``<path>/versions/<name>/`` holds one complete version (data and schema), ``<path>/_current.json``
names the one to read.  A new version is written once, under a name of its own, through
Spark's commit protocol; then the pointer is replaced by a rename.  A write that breaks off
anywhere before that rename leaves the old table as it was, and a reader has either the old
version or the new.  The version that was current before stays for readers that have
begun with it; older ones are removed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyspark.sources.files import Files

_POINTER, _VERSIONS = "_current.json", "versions"


def _pointer(path: str) -> str:
    return f"{path}/{_POINTER}"


def current_version(spark: SparkSession, path: str) -> dict | None:
    """``{"version", "previous", "schema", "notes"}`` of the table at ``path``, or None when there is none."""
    return Files(spark, path).read(_pointer(path))


def version_folder(spark: SparkSession, path: str) -> str | None:
    """The folder of the current version, for tools that read plain parquet."""
    now = current_version(spark, path)
    return None if now is None else f"{path}/{_VERSIONS}/{now['version']}"


def replace_table(df: DataFrame, path: str, notes: dict | None = None, based_on: str | None = None) -> str:
    """Write ``df`` as the next version of the table at ``path`` and switch to it; the version's name.

    ``notes`` (JSON values) are stored in the pointer and change with the data, in one step.
    ``based_on``: the version that ``df`` was computed from; if another one is current by
    now, nothing is switched and a ``RuntimeError`` tells so.
    """
    spark = df.sparkSession
    name = uuid.uuid4().hex
    df.write.parquet(f"{path}/{_VERSIONS}/{name}")
    return switch(spark, path, name, df.schema.jsonValue(), notes, based_on)


def switch(spark: SparkSession, path: str, name: str, schema: dict, notes: dict | None = None,
           based_on: str | None = None) -> str:
    """Make a completely written version the current one."""
    files = Files(spark, path)
    before = files.read(_pointer(path)) or {}
    if based_on is not None and before.get("version") != based_on:
        files.delete(f"{path}/{_VERSIONS}/{name}")
        raise RuntimeError(f"{path}: the version {based_on} is not current any more")
    files.write(_pointer(path), {"version": name, "previous": before.get("version"), "schema": schema,
                                 "notes": notes or {}})
    if before.get("previous"):
        files.delete(f"{path}/{_VERSIONS}/{before['previous']}")
    return name


def read_table_version(spark: SparkSession, path: str) -> DataFrame:
    """The current version of the table at ``path``."""
    from pyspark.sql.types import StructType

    now = current_version(spark, path)
    if now is None:
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.schema(StructType.fromJson(now["schema"])).parquet(f"{path}/{_VERSIONS}/{now['version']}")
