"""Per-date row counts of a partitioned folder, kept beside it and renewed for changed partitions only.

``<ledger>`` is a versioned table ``(partition, trx_date, n)``: for each partition folder of the
landing table the rows of each date that it held when it was counted.  Its notes hold
a fingerprint of every counted partition (names, sizes and times of its files), so a
run lists the folders, counts those whose fingerprint is new or has changed, and drops
those that are gone; rows of all other partitions are not read again.  Reconciliation
then adds up a few numbers per date instead of scanning the history.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import columns as C
from tallyspark.operators.reconcile import _as_col
from tallyspark.sources.files import Files
from tallyspark.sources.versions import current_version, read_table_version, replace_table

PARTITION = "partition"


def fingerprints(spark: SparkSession, folder: str) -> dict[str, str]:
    """``{partition folder: fingerprint}`` of the first-level partitions of ``folder``."""
    marks: dict[str, list] = {}
    for name, size, time in Files(spark, folder).files_below(folder):
        top = name.split("/", 1)[0]
        if "=" in top:
            marks.setdefault(top, []).append((name, size, time))
    return {top: hashlib.sha256(repr(files).encode()).hexdigest() for top, files in marks.items()}


def renew_counts(spark: SparkSession, folder: str, ledger: str, date_column, schema=None) -> list[str]:
    """Bring the ledger up to date with ``folder``; the partitions that were counted anew.

    ``date_column`` is a column or expression of the folder's rows; rows whose date is NULL are
    counted under NULL.  ``schema``: of the folder, if its footers should not be asked.
    """
    now = fingerprints(spark, folder)
    before = current_version(spark, ledger)
    known = before["notes"] if before else {}
    changed = sorted(top for top, mark in now.items() if known.get(top) != mark)
    gone = [top for top in known if top not in now]
    if before and not changed and not gone:
        return []
    empty = spark.createDataFrame([], f"{PARTITION} string, {C.INC_DATE} date, n bigint")
    counts = empty if before is None else read_table_version(spark, ledger).where(
        ~F.col(PARTITION).isin([*changed, *gone]))
    if changed:
        reader = spark.read.option("basePath", folder)
        rows = (reader if schema is None else reader.schema(schema)).parquet(*[f"{folder}/{top}" for top in changed])
        counts = counts.unionByName(
            rows.groupBy(_top_folder(spark, folder).alias(PARTITION), _as_col(date_column).cast("date").alias(C.INC_DATE))
            .agg(F.count(F.lit(1)).alias("n")))
    replace_table(counts, ledger, notes=now, based_on=before and before["version"])
    return changed


def _top_folder(spark: SparkSession, folder: str):
    """The name of the first folder below ``folder`` that a row's file lies in."""
    base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder).toUri().getPath()
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(path, r"\Q" + base + r"\E/+([^/]+)/", 1)


def ledger_counts(spark: SparkSession, ledger: str, name: str = "n") -> DataFrame:
    """``(trx_date, name)``: rows per date over all partitions, from the ledger alone."""
    return read_table_version(spark, ledger).groupBy(C.INC_DATE).agg(F.sum("n").alias(name))
