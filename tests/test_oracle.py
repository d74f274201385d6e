"""Every registered query against its DuckDB oracle on the smallest table set."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from aerolake.plans import registry
from aerolake.sources.tables import TABLES
from tests.conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def _norm(v):
    if v is None:
        return "<NULL>"
    if isinstance(v, float):
        return "<NaN>" if math.isnan(v) else f"{v:.9g}"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) <= set(QUERIES)
    missing = sorted(set(registry.queries()) - set(ORACLE))  # others are compared with brute force
    assert missing == [], f"queries without oracle SQL: {missing}"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _canon(df.columns, srows) == _canon(ocols, orows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["airport_code", "num_departures", "avg_duration_min"]
    assert 0 < df.count() <= 10
