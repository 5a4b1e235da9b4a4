"""Small helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import discard_scratch, scratch_path
from tallyspark.sources.tables import read_table

#: White space and words as every operator here understands them.
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = "[\\x20\\x09-\\x0D]+"

#: Bytes of rows that a worker of the pipeline gets at a time (a longer row is sent alone).
BATCH_BYTES = 4 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEAN_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="tallyspark-code-")  # the driver's own; its file server hands the file out
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "tallyspark_code"), "zip",
                                     os.path.dirname(package), os.path.basename(package)))
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return read_table(spark, sf_dir, name)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id long, text string)`` of each row; a null text is empty, other columns are dropped."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def fold_of(id_col: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds``; -1 for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds, F.lit(-1))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later jobs restart from the files.

    Its shuffle files go when it is written; else they stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEAN_KEY, None)
    spark.conf.set(_CLEAN_KEY, True)
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN_KEY)
        else:
            spark.conf.set(_CLEAN_KEY, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Remove the files of tables that ``written`` gave, when all that reads them is written itself."""
    for t in tables:
        discard_scratch(t.sparkSession, t._stored_at)


def give_back() -> None:
    """Return memory that a Python worker has freed to the system: workers outlive the stage that filled them."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library; it keeps what it keeps
        return


def small_batches(spark: SparkSession) -> None:
    """Send workers ``BATCH_BYTES`` of rows at a time, unless the session says how many.

    A batch is held several times over, by the worker and by the JVM that writes it.
    """
    if spark.conf.get(_BATCH_KEY, None) is None:
        spark.conf.set(_BATCH_KEY, BATCH_BYTES)


def unused(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have yet."""
    have = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name.lower() in have:
        name += "_"
    return name
