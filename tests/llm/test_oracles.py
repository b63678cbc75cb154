"""The llm queries that have SQL, against it, on the smallest tables."""

import math

import duckdb
import pytest

from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _sorted(cols, rows):
    order = sorted(range(len(cols)), key=cols.__getitem__)
    norm = lambda v: "" if v is None else f"{v:.9f}" if isinstance(v, float) and not math.isnan(v) else str(v)
    return [cols[k] for k in order], sorted(tuple(norm(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    want = con.execute(ORACLE[name])
    assert _sorted(df.columns, [tuple(r) for r in df.collect()]) == _sorted([c[0] for c in want.description], want.fetchall())
