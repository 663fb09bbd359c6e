"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry
from courtline import oracle, registry
from tests.conftest import SF_SMALL

QUERIES = registry.QUERIES
ORACLE = oracle.ORACLE
TABLES = "nation customer supplier orders lineitem events".split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, (float, decimal.Decimal)):
        return repr(float(v))
    return str(v)


def _multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return con


def test_every_key_has_oracle_or_is_rows_only():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[key])
    o_cols, o_rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert _multiset(s_cols, s_rows) == _multiset(o_cols, o_rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "overall_rank" in df.columns
