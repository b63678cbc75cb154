"""Whitening against exact integers and numpy's eigenvectors."""

import math

import numpy as np
import pytest

from tidemark.llm import whitening
from tidemark.llm.queries import QUERIES

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def slow(rows, components=32):
    """{(vec_id, component): (deviation, whitened up to its sign, explained)} with distinct ids."""
    x = {i: [math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for i, v in rows}
    n, sums = len(x), [sum(c) for c in zip(*x.values())]
    y = {i: [n * a - s for a, s in zip(v, sums)] for i, v in x.items()}
    z = np.array([[a / n for a in v] for v in y.values()])
    cov = z.T @ z / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    keep = [k for k in range(min(components, len(e))) if e[k] > e[0] * 1e-12]
    out = {}
    for i, v in y.items():
        for k in keep:
            out[i, k + 1] = (sum(a * a for a in v), float(np.array(v) / n @ u[:, k] / math.sqrt(e[k])), e[k] / e.sum())
    return out, n


def check(got, rows, components=32, gaps=True):
    want, n = slow(rows, components)
    assert {(r.vec_id, r.component) for r in got} == set(want) and len(got) == len(want)
    signs = {}
    for r in got:
        deviation, w, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation) and r.explained == pytest.approx(explained, rel=1e-9)
        assert 0 <= r.identity_error < 1e-9
        if gaps and abs(w) > 1e-6:
            signs.setdefault(r.component, math.copysign(1, w * r.whitened))
            assert r.whitened * signs[r.component] == pytest.approx(w, rel=1e-6, abs=1e-8)
    return signs


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 1, 0.5) for i, v in rows], f"vec_id long, embedding array<{kind}>, n int, whitened double")


def vectors(seed, n, d, scale=1.0):
    r = np.random.default_rng(seed)
    mix = r.normal(size=(d, d)) * np.geomspace(1, 0.05, d)[:, None]
    return [(i, [float(np.float32(c)) for c in row]) for i, row in enumerate(scale * r.normal(size=(n, d)) @ mix)]


@pytest.mark.parametrize("d,n", [(1, 5), (7, 200), (40, 300)])
def test_whitened(spark, d, n):
    rows = vectors(d, n, d, 5.0)
    got = whitening.whiten(frame(spark, rows).repartition(5))
    assert got.columns == COLUMNS
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                                "explained": "double", "identity_error": "double"}
    check(got.collect(), rows)


def test_odd_vectors(spark):
    rows = vectors(3, 60, 4, 3.0)
    bad = [(900, None), (901, []), (902, [1.0, None, 0.0, 0.0]), (903, [float("nan"), 0.0, 0.0, 0.0]), (904, [0.0, float("-inf"), 0.0, 0.0]),
           (905, [1.0, 2.0]), (906, [3e38, 0.0, 0.0, 0.0])]
    check(whitening.whiten(frame(spark, rows + bad)).collect(), rows)


def test_repeated_rows_and_null_ids(spark):
    rows = vectors(4, 30, 3)
    df = frame(spark, rows + rows[:10] + [(None, rows[0][1])] * 2)
    got = whitening.whiten(df).collect()
    assert len(got) == 42 * 3 and {r.n for r in got} == {42} and sum(r.vec_id is None for r in got) == 6
    distinct = {}
    for r in got:
        distinct.setdefault((r.vec_id, r.component), set()).add((r.deviation, r.whitened))
    assert all(len(v) == 1 for v in distinct.values())


def test_smaller_rank(spark):
    base = vectors(5, 50, 3, 4.0)
    rows = [(i, v + [2.0, v[0], -v[1]]) for i, v in base]  # a constant and two copies up to rounding
    got = whitening.whiten(frame(spark, rows)).collect()
    check(got, rows, gaps=False)
    assert whitening.whiten(frame(spark, [(i, [1.0, 2.0]) for i in range(5)])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0])])).count() == 0


def test_empty(spark):
    assert whitening.whiten(frame(spark, []).limit(0)).columns == COLUMNS
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).count() == 0


def test_large_values_stay_exact(spark):
    rows = [(i, [float(2 ** 40 * (i % 7)), float(i * i), 1.0 * i]) for i in range(50)]
    got = whitening.whiten(frame(spark, rows, "double"))
    x = {i: [math.floor(64 * c) + 1000000 for c in v] for i, v in rows}
    sums = [sum(c) for c in zip(*x.values())]
    for r in got.where("component = 1").collect():
        exact = sum((50 * a - s) ** 2 for a, s in zip(x[r.vec_id], sums))
        assert r.deviation == (exact if exact < 2 ** 63 else None)


def test_factor_and_rotations():
    r = np.random.default_rng(0)
    for d in (1, 2, 5, 33):
        m = r.normal(size=(d, d)) * np.geomspace(1, 1e-5, d)
        v = m @ m.T
        f = whitening.pivoted_cholesky(v)
        assert np.abs(f @ f.T - v).max() <= 1e-12 * v.max()
        e, u = whitening.one_sided_jacobi(f)
        assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-11 and (np.diff(e) <= 0).all()
        assert np.abs(u * e @ u.T - v).max() <= 1e-11 * v.max()
    order = np.argsort(-np.diag(v))[0]
    assert np.count_nonzero(whitening.pivoted_cholesky(v)[order]) == 1  # triangular up to the order of its rows


def test_given_table(spark):
    got = QUERIES["op13_whitening"](spark, "/root/testdata/sf0.001").collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    check(got, rows)
