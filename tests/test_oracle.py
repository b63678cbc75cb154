"""Every registered batch query against its DuckDB oracle on sf0.001."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidemark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
FAST = [k for k in oracle_sql() if k in QUERIES and not k.startswith("stream_")]


def _norm(v):
    if v is None:
        return ""
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    if hasattr(v, "item"):
        v = v.item()
    return str(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events",):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "vwap" in df.columns


def test_every_market_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.skipif(not os.path.exists(SF), reason="test data missing")
@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    got = _rows(queries()[name](spark, SF).toPandas())
    exp = _rows(con.execute(oracle_sql()[name]).df())
    assert got == exp
