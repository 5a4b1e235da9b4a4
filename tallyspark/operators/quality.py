"""Rounding by column type and the non-null profile of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark import columns as C

_FLOATING = ("double", "float")


def round_floats(df: DataFrame, scale: int = 2) -> DataFrame:
    """Round every double/float column to ``scale`` places (half up); other columns pass unchanged.

    Decimal columns are left as they are, like every non-floating type.
    """
    return df.select(*[
        F.round(F.col(name), scale).alias(name) if dtype in _FLOATING else F.col(name)
        for name, dtype in df.dtypes
    ])


def non_null_profile(df: DataFrame) -> DataFrame:
    """``(column_name, non_null_count)``, one row per column, from a single global aggregate."""
    names = df.columns
    counts = df.agg(*[F.count(F.col(n)).alias(n) for n in names])
    return counts.unpivot([], names, C.PROFILE_COLUMN, C.PROFILE_COUNT)
