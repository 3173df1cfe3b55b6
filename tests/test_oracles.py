"""Every SQL twin equals its Spark query (sf0.001; the driver checks sf0.01)."""
import math

import pytest

import __spark_entry__ as E
from tessera.plans.tables import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _key(v):
    return (v is None, str(type(v)), v if v is not None else 0)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(r[i] for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda r: tuple(_key(x) for x in r))


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_twin_matches(spark, duck, name):
    df = E.queries()[name](spark, SF)
    s_cols, s_rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.sql(E.oracle_sql()[name])
    d_cols, d_rows = _rows(rel.columns, rel.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    for a, b in zip(s_rows, d_rows):
        for x, y in zip(a, b):
            if isinstance(x, float) or isinstance(y, float):
                assert math.isclose(float(x), float(y), rel_tol=1e-9, abs_tol=1e-9), (a, b)
            else:
                assert x == y, (a, b)
