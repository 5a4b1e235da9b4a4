"""Every registered query against its DuckDB oracle on the smallest supplied tables."""

import pytest

from tallyspark.plans import catalog, oracle

duckdb = pytest.importorskip("duckdb")

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
QUERIES = sorted(catalog.queries())


def _norm(v):
    if v is None:
        return "\0NULL"
    if isinstance(v, float):
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, sf_small, duck, name):
    df = catalog.queries()[name](spark, sf_small)
    sql = oracle.oracle_sql()[name]
    cur = duck.execute(sql)
    ocols = [d[0] for d in cur.description]
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    want = _canon(ocols, cur.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]
