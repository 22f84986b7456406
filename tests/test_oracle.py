"""Every registered query against its DuckDB oracle at sf0.001 (the driver checks sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from odflow import oracle, queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = oracle.oracle_sql()
QUERIES = queries.registry()
KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(r[i] for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def test_every_query_has_an_oracle():
    assert set(KEYS) == set(SQL)
    assert set(SQL) <= set(KEYS)
    assert set(KEYS) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["nombre", "workday_v", "weekend_v", "ratio", "percentile"]
    df.collect()


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[key])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    a, b = _norm(rows, df.columns), _norm(res.fetchall(), ocols)
    assert len(a) == len(b)
    for r, s in zip(a, b):
        for x, y in zip(r, s):
            if isinstance(x, float) and isinstance(y, float):
                assert math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-12), (key, r, s)
            else:
                assert x == y, (key, r, s)
