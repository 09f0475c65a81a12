"""Every registered query against its DuckDB oracle on the smallest test tables."""

from __future__ import annotations

import datetime as dt
import decimal
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from ledgerline.registry import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return None if v is None else str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "part", "orders", "lineitem", "supplier"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_registry_shape():
    q, o = E.queries(), E.oracle_sql()
    own = {k for k in q if not k.startswith("op") and k != "pipeline"}
    assert len(own) == 45
    assert own <= set(o) <= set(q)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "profit_margin_pct" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert _bag(df.columns, rows) == _bag(rel.columns, orows)
