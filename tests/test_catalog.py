import os

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry
from tripmart.plans.catalog import ORACLE_SQL, QUERIES, ROWS_ONLY

sys_path_ok = True
TABLES = "region nation customer supplier part orders lineitem".split()


def test_every_query_has_sql_or_is_rows_only():
    q, o = QUERIES, ORACLE_SQL
    assert set(q) <= set(entry.queries()) and set(o) <= set(entry.oracle_sql())
    assert set(q) == set(o) | ROWS_ONLY
    assert not (ROWS_ONLY & set(o))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "mom_revenue_growth_pct" in df.columns


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    import datetime as dt
    import decimal

    if isinstance(v, float):
        return "nan" if v != v else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    res = duck.execute(ORACLE_SQL[name])
    d_cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, df.collect()) == _rows(d_cols, res.fetchall())


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0
    assert os.path.isdir(SF_SMALL)
