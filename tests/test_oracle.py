"""Every registered query with a SQL form equals its DuckDB oracle (sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from canopy.plans.checks import CHECKS
from canopy.plans.large import LARGE, LARGE_SQL
from canopy.plans.oracle import ORACLE_SQL
from canopy.plans.queries import QUERIES
from conftest import SF_SMALL

TABLES = ["part", "lineitem", "embeddings"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL | LARGE_SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == _rows(dcols, res.fetchall())


def test_every_query_runs(spark):
    for name in QUERIES | CHECKS | LARGE:
        fn = E.queries()[name]
        if name in ORACLE_SQL | LARGE_SQL:
            continue
        assert fn(spark, SF_SMALL).count() >= 0, name


def test_entry(spark):
    df = E.entry(spark)
    r = df.collect()
    assert len(r) == 1 and r[0]["n_test"] > 0
