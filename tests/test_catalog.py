"""Every query of the catalogue against its SQL in another engine, on the smallest tables."""

import os

import pytest

from blockloom import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return con


def _value(x):
    if x is None or x != x:
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, (int, float)):
        return round(float(x), 6)
    return float(x) if type(x).__name__ == "Decimal" else str(x)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([_value(r[i]) for i in order]) for r in rows)


def test_all_queries_have_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    want = duck.sql(catalog.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert _rows(df.columns, df.collect()) == _rows(want.columns, want.fetchall())
