"""Registered queries of the subpackage against their DuckDB SQL on the smallest supplied tables."""

import pytest

from tallyspark.llm import queries

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, sf_small, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    found = con.execute(queries.oracle_sql()[name])
    columns = sorted(d[0] for d in found.description)
    df = queries.queries()[name](spark, sf_small)
    assert sorted(df.columns) == columns
    place = [[d[0] for d in found.description].index(c) for c in columns]
    want = sorted((tuple(r[k] for k in place) for r in found.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) == want
