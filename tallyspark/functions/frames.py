"""Small DataFrame helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def first_column(df: DataFrame, name: str) -> DataFrame:
    """The first column of ``df`` alone, renamed ``name``.

    Renaming by position works whatever the generated column name is (a query's
    ``count(t.x)`` or ``max(CAST(ts AS DATE))`` would not resolve as a name).
    """
    names = [name] + [f"_c{i}" for i in range(1, len(df.columns))]
    return df.toDF(*names).select(name)
