import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ball_tree


def slow_top(rows, k=20):
    q = {i: np.floor(64 * np.array(v, np.float64)).astype(np.int64) for i, v in rows}
    out = []
    for i in q:
        if i % 20 == 0:
            best = sorted((-int(q[i] @ q[j]), j) for j in q if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("shard,block", [(40, 3), (100_000, 2048)])
def test_top_k(spark, monkeypatch, shard, block):
    monkeypatch.setattr(ball_tree, "SHARD_ROWS", shard)
    monkeypatch.setattr(ball_tree, "BLOCK_ROWS", block)
    r = np.random.default_rng(shard)
    rows = [(i, [float(x) for x in r.normal(size=6) * r.choice([0.1, 1, 5])]) for i in range(300)]
    rows += [(400 + i, rows[20][1]) for i in range(30)]  # equal vectors: ties
    bad = [(500, None), (520, []), (540, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (560, [float("nan")] * 6), (580, [float("inf")] + [0.0] * 5), (None, [1.0] * 6)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows + bad], "vec_id long, embedding array<double>, rank int")
    got = sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in ball_tree.top_k(df, F.col("vec_id") % 20 == 0).collect())
    assert got == slow_top(rows)


def test_fewer_than_k_and_empty(spark):
    rows = [(0, [1.0, -2.0]), (1, [0.5, 0.5]), (20, [3.0, 1.0])]
    df = spark.createDataFrame(rows + rows[:1], "vec_id long, embedding array<float>")
    got = sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in ball_tree.top_k(df, F.col("vec_id") % 20 == 0).collect())
    assert got == slow_top(rows)
    assert ball_tree.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_bounds_prune():
    """Far nodes are not searched once the kth score is known."""
    r = np.random.default_rng(1)
    near, far = r.integers(900, 1000, (500, 8)), r.integers(-1000, -900, (500, 8))
    tree = ball_tree.BallTree(np.arange(1000), np.concatenate([near, far]), leaf=50)
    seen = []

    class Rows(np.ndarray):
        def __getitem__(self, k):
            seen.append(k)
            return np.asarray(super().__getitem__(k))

    tree.rows = tree.rows.view(Rows)
    ids = np.arange(2000, 2003)
    of, found, score = tree.search(ids, near[:3], 5, np.full(3, ball_tree.NONE))
    assert len(of) == 15 and all(f < 500 for f in found)
    want = [sorted((int(a @ b) for b in near), reverse=True)[:5] for a in near[:3]]
    assert [sorted(score[of == i].tolist(), reverse=True) for i in range(3)] == want


def test_root_bounds_drop_pairs(spark, monkeypatch):
    """Queries go on only to shards whose root ball can hold better rows; nothing is lost."""
    monkeypatch.setattr(ball_tree, "SHARD_ROWS", 60)
    monkeypatch.setattr(ball_tree, "BLOCK_ROWS", 10)
    monkeypatch.setattr(ball_tree, "ROOTS", 3)
    r = np.random.default_rng(5)
    directions = r.normal(size=(8, 12)) * 8
    rows = [(i, [float(x) for x in directions[i % 8] + r.normal(size=12) * 0.2]) for i in range(800)]
    stored, materialize = {}, ball_tree.materialize

    def counted(df, name, *a):
        out = materialize(df, name, *a)
        stored[name] = out.count()
        if name == "reached-shards":
            stored["exchanged"] = out.columns
        return out

    monkeypatch.setattr(ball_tree, "materialize", counted)
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    got = sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in ball_tree.top_k(df, F.col("vec_id") % 20 == 0, 5).collect())
    assert got == slow_top(rows, 5)
    possible = stored["query-blocks"] * (stored["ball-trees"] - 1)
    assert stored["ball-trees"] >= 10 and stored["reached-shards"] < possible / 2
    assert stored["exchanged"] == ["shard", "block_no", "blob"]  # no tree


def test_overflow_is_an_error():
    tree = ball_tree.BallTree(np.arange(2), np.array([[2 ** 40] * 2, [1, 1]]))
    with pytest.raises(OverflowError):
        tree.search(np.array([5]), np.array([[2 ** 40] * 2]), 1, np.full(1, ball_tree.NONE))
    exact = ball_tree.BallTree(np.arange(2), np.array([[2 ** 30, 1], [1, 1]]))
    _, ids, score = exact.search(np.array([5]), np.array([[2 ** 30 + 1, 3]]), 1, np.full(1, ball_tree.NONE))
    assert score.tolist() == [2 ** 30 * (2 ** 30 + 1) + 3]


def test_random_trees():
    r = random.Random(0)
    for n in (1, 2, 7, 129, 400):
        rows = np.array([[r.randint(-9, 9) for _ in range(3)] for _ in range(n)])
        tree = ball_tree.BallTree(np.arange(n), rows, leaf=4)
        assert sorted(tree.ids.tolist()) == list(range(n))
        for (a, b, _, _), c, radius in zip(tree.nodes, tree.centres, tree.radii):
            assert (np.sqrt(((tree.rows[a:b] - c) ** 2).sum(1)) <= radius + 1e-9).all()
