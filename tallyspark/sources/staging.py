"""Staging an intermediate result as a parquet table in the session's shared folder.

Used where one expensive input feeds two passes (the KPI anchor and the KPI
aggregation): the input is computed once, written through the commit protocol
under ``spark.checkpoint.dir`` and read back, so the lineage is cut (a lost
executor re-reads the table instead of recomputing the joins) and each later
pass reads only the columns it needs from a columnar file.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from tallyspark.session import discard_scratch, scratch_path


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and return the read-back table."""
    path = scratch_path(df.sparkSession, f"stage-{name}")
    _staged.append(path)
    return _store(df, path)


_staged: list[str] = []


def release_staged(spark) -> int:
    """Remove every table that ``stage_table`` has written in this process, once its readers are done; their number."""
    n = len(_staged)
    while _staged:
        discard_scratch(spark, _staged.pop())
    return n


@contextmanager
def staged_table(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``stage_table`` for one block: the staged copy is removed when the block ends.

    Everything that reads it must be written inside the block.
    """
    path = scratch_path(df.sparkSession, f"stage-{name}")
    try:
        yield _store(df, path)
    finally:
        discard_scratch(df.sparkSession, path)


def _store(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    # the schema is known: reading it back needs no footer-inference job
    return df.sparkSession.read.schema(df.schema).parquet(path)
