"""Sinks: KPI table overwrite, audit append, partitioned landing; and their read-backs.

Every write goes through Spark's file commit protocol: a lost executor's task is
re-run without leaving partial files.  The KPI table is written as a new version and
switched to by renaming a pointer (``versions``).  Runs of the audit are entered in a
ledger.  Landing writes overwrite only the day they carry (dynamic partition
overwrite); an empty extract replaces its day by no rows.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyspark.sources.files import Files
from tallyspark.sources.versions import read_table_version, replace_table

RUN_DATE = "run_date"
RUN_ID = "run_id"
TRX_DATE = "trx_date"
EPOCH, EPOCH_DAY = "epoch_time", "epoch_day"
_RUN_KEYS = ("dag_name", "target_table", "table_name")  # what a run's rows are about


def write_kpi(df: DataFrame, path: str, notes: dict | None = None) -> str:
    """Replace the KPI table at ``path`` (data and schema); read it with ``read_kpi``.

    The table is written once, as a version of its own, and a pointer is switched to it
    by a rename: a write that breaks off leaves the old table, readers never find none.
    """
    replace_table(df, path, notes)
    return path


def read_kpi(spark: SparkSession, path: str) -> DataFrame:
    """The KPI table as ``write_kpi`` last left it."""
    return read_table_version(spark, path)


def append_audit(df: DataFrame, path: str, partition_by=(RUN_DATE,), unique_key=None, run_id: str | None = None,
                 run_date=None) -> str:
    """Append audit rows (one write for all dates of a run), partitioned by run date.

    ``run_id`` (the scheduler's) makes a retried run idempotent.  It is stored with the rows, and
    the run is entered in the ledger ``<path>/_ledger`` by its id, run date and audited tables:
    a retry whose run is in the ledger adds nothing, whatever its timestamps say and whatever
    columns older files have; the data is not read for it.  The rows are written aside first and
    the entry lists their files, so a run that broke off while they were moved in is finished by its retry.

    Without a run id rows are always appended; ``unique_key`` (columns) then leaves out rows
    that the table has already, by those columns and the run date.  ``run_date`` is the run's
    date in the ledger (default: from the rows, if they have one only) and, with ``unique_key``, restricts the look-up.

    Rows with an ``epoch_time`` get its day as the partition column ``epoch_day``, unless the table is partitioned otherwise.
    """
    spark = df.sparkSession
    files = Files(spark, path)
    there = _partition_columns(files, path)
    if EPOCH in df.columns and EPOCH_DAY not in df.columns and (there is None or EPOCH_DAY in there):
        df, partition_by = df.withColumn(EPOCH_DAY, epoch_day(F.col(EPOCH))), (EPOCH_DAY,)
    if run_id is None:
        if unique_key is not None:
            df = _not_there(df, path, [unique_key] if isinstance(unique_key, str) else list(unique_key), run_date)
        w = df.write.mode("append")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
        return path
    keys = [c for c in _RUN_KEYS if c in df.columns]
    day = None if run_date is None else _run_date(run_date)
    if day is None:
        keys += [c for c in (RUN_DATE, "load_date") if c in df.columns]
    named = {"run_id": run_id, "run_date": day}
    # a run's rows are few (one per date or table) and are built from counts: they are written before they are named
    aside = f"{path}/_aside/{uuid.uuid4().hex}"
    df = df.withColumn(RUN_ID, F.lit(run_id))
    if day is not None and not keys and _entered(files, path, named):
        return path
    w = df.write
    (w.partitionBy(*partition_by) if partition_by else w).parquet(aside)
    written = spark.read.schema(df.schema).parquet(aside)
    if keys:  # one line per set of audited tables and dates
        told = [r.asDict() for r in written.select(*keys).distinct().collect()]
        named["of"] = sorted(json.dumps(t, default=str, sort_keys=True) for t in told)
    entry = _entered(files, path, named)
    if entry is None:
        entry = named | {"files": [f for f, _, _ in files.files_below(aside)], "aside": aside, "done": False}
        if not files.write(_entry_path(path, named), entry, replace=False):
            entry = _entered(files, path, named)  # another attempt of the run came first
    if not entry["done"]:
        for name in entry["files"]:
            source = f"{entry['aside']}/{name}"
            if files.exists(source):
                files.move(source, f"{path}/{name}")
        files.write(_entry_path(path, named), entry | {"done": True})
    files.delete(entry["aside"])
    if aside != entry["aside"]:
        files.delete(aside)
    return path


def committed_runs(spark: SparkSession, path: str) -> list[dict]:
    """The ledger of an audit table: run id, run date and files of each committed run."""
    files = Files(spark, path)
    found = (files.read(f"{path}/_ledger/{n}") for n in files.names(f"{path}/_ledger") if n.endswith(".json"))
    return [e for e in found if e and e["done"]]


def _entry_path(path: str, named: dict) -> str:
    return f"{path}/_ledger/{hashlib.sha256(json.dumps(named, sort_keys=True).encode()).hexdigest()[:32]}.json"


def _entered(files: Files, path: str, named: dict) -> dict | None:
    return files.read(_entry_path(path, named))


def _partition_columns(files: Files, path: str) -> list[str] | None:
    """The partition columns of the table at ``path`` by its folders; None when there is no table yet."""
    at, out = path, []
    while True:
        names = [n for n in files.names(at) if n[:1] not in "_."]
        deeper = [n for n in names if "=" in n]
        if not deeper:
            return out if names or out else None
        out.append(deeper[0].split("=", 1)[0])
        at = f"{at}/{deeper[0]}"


def _not_there(df: DataFrame, path: str, keys: list[str], run_date) -> DataFrame:
    """The rows of ``df`` whose keys (and run date) the table at ``path`` does not have."""
    existing = _read_or_none(df.sparkSession, path)
    if existing is None:
        return df
    if RUN_DATE in df.columns and RUN_DATE in existing.columns and RUN_DATE not in keys:
        keys = keys + [RUN_DATE]
    if missing := [k for k in keys if k not in existing.columns]:
        raise ValueError(f"{path} has no column {', '.join(missing)} to tell rows by")
    if run_date is not None and RUN_DATE in existing.columns:
        existing = existing.where(F.col(RUN_DATE) == F.to_date(F.lit(_run_date(run_date))))
    there = existing.select(*[F.col(k).alias(f"_there_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_there_{k}")) for k in keys])
    return df.join(there, same, "left_anti")


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path`` with the columns of all its files, or None when there is none yet."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def epoch_day(epoch):
    """The UTC day of epoch seconds, as a date (a column for a column, else a literal)."""
    if not isinstance(epoch, Column):
        return F.to_date(F.lit(_dt.datetime.fromtimestamp(int(epoch), _dt.timezone.utc).strftime("%Y-%m-%d")))
    return F.date_add(F.to_date(F.lit("1970-01-01")), F.floor(epoch / 86400).cast("int"))


def read_audit(spark: SparkSession, path: str, dag_name: str | None = None, table_name: str | None = None,
               epoch_time: int | None = None) -> DataFrame:
    """Audit rows read back, optionally of one dag, table and run epoch (pushed to the scan).

    The columns are those of all files, NULL where older ones lack them.  With ``epoch_time``, a table
    partitioned by the epoch's day is read in that day's folder only.
    """
    df = spark.read.option("mergeSchema", "true").parquet(path)
    if dag_name is not None:
        df = df.where(F.col("dag_name") == F.lit(dag_name))
    if table_name is not None:
        df = df.where(F.col("table_name") == F.lit(table_name))
    if epoch_time is not None:
        if EPOCH_DAY in df.columns:
            df = df.where(F.col(EPOCH_DAY) == epoch_day(epoch_time))
        df = df.where(F.col(EPOCH) == F.lit(int(epoch_time)))
    return df.drop(EPOCH_DAY)


def _run_date(value) -> str:
    if isinstance(value, (_dt.date, _dt.datetime)):
        return value.strftime("%Y-%m-%d")
    return str(value)


def extract_to_landing(df: DataFrame, path: str, run_date) -> str:
    """Write an extract under ``path/run_date=<day>/``, replacing only that day's partition.

    Dynamic overwrite replaces partitions that get rows; when the extract had none
    (counted in the same job), the day's folder is overwritten by an empty file.
    """
    if RUN_DATE in df.columns:
        raise ValueError(f"the extract has a column named {RUN_DATE}, which the landing folder adds")
    day, seen = _run_date(run_date), Observation()
    (df.observe(seen, F.count(F.lit(1)).alias("rows"))
       .withColumn(RUN_DATE, F.to_date(F.lit(day)))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(RUN_DATE).parquet(path))
    if seen.get["rows"] == 0:
        empty = df.sparkSession.createDataFrame([], df.schema)
        empty.write.mode("overwrite").parquet(f"{path}/{RUN_DATE}={day}")
    return path


def land_and_count(df: DataFrame, path: str, run_date, counts: dict | None = None) -> dict[str, int]:
    """``extract_to_landing`` that counts while it writes: ``{"rows": all, name: rows of that condition, ...}``.

    The counts are metrics of the writing job itself, so the source is read once; a
    condition that is NULL does not count.  They feed the per-table audit and the summary
    (``operators.audit.given_count``).
    """
    seen = Observation()
    metrics = [F.count(F.when(c, F.lit(1))).alias(name) for name, c in (counts or {}).items()]
    extract_to_landing(df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics), path, run_date)
    return dict(seen.get)


def read_landing(spark: SparkSession, path: str, run_date=None) -> DataFrame:
    """The landing table, or one day of it (the filter prunes partitions, other days are not listed)."""
    df = spark.read.parquet(path)
    if run_date is not None:
        df = df.where(F.col(RUN_DATE) == F.to_date(F.lit(_run_date(run_date))))
    return df
