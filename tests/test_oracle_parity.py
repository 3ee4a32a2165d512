"""Every registered query with an oracle returns the same rows as its DuckDB twin
(on the smallest scale, so the suite stays quick)."""

import datetime as dt
import decimal
import math

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    want = _rows(ocols, cur.fetchall())
    assert got == want


def test_every_query_has_a_unique_name():
    assert len(QUERIES) == len(set(QUERIES))
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert {"site", "rank_sales", "rank_desserts"} <= set(df.columns)
