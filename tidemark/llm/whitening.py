"""Whitening of embeddings by a pivoted Cholesky factor and one-sided Jacobi rotations.

Three passes over the vectors gather sums whose size depends on the dimension alone:
counts and exact sums per dimension, then the scatter of the centred vectors, then the covariance of the
whitened ones (the reported error). The driver sees these matrices only. The scatter V is
factored with diagonal pivoting, P'VP = LL'; rotations from the right make the
columns of L orthogonal, LJ = US, so V = US(US)': column norms squared are the eigenvalues and
normalised columns, rows put back in order, the components. The scatter itself
is never rotated, so no precision is lost to its squared condition.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 32
OFFSET = 1_000_000
LONG = 2 ** 63


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v): vectors that are not null, hold no null or non-finite entry, and whose
    entries fit the long form."""
    v = F.col("embedding").cast("array<double>")
    return (embeddings.select("vec_id", v.alias("v")).where("v IS NOT NULL")
            .where(F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < F.lit(2.0 ** 52)))))  # false for nan, too


def _longs(column, dim: int) -> np.ndarray:
    """x = floor(64 c) + 1000000 of a batch of vectors of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(64.0 * flat).astype(np.int64).reshape(len(column), dim) + OFFSET


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """F with FF' = V (rows in V's order): columns of the triangular factor in the order in
    which the largest remaining diagonal entry is chosen, as far as it stands out of rounding."""
    left, d = np.array(v, float), len(v)
    diagonal = np.diag(left).copy()
    least = d * np.finfo(float).eps * max(diagonal.max(initial=0.0), 0.0)
    factor = np.zeros((d, 0))
    used = np.zeros(d, bool)
    for _ in range(d):
        p = int(np.where(used, -np.inf, diagonal).argmax())
        if used[p] or diagonal[p] <= least:
            break
        column = (left[:, p] - factor @ factor[p]) / np.sqrt(diagonal[p])
        column[used] = 0.0
        column[p] = np.sqrt(diagonal[p])
        factor = np.column_stack([factor, column])
        diagonal -= column ** 2
        used[p] = True
    return factor


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of FF': pairs of columns are
    rotated until all are orthogonal. A round handles disjoint pairs at once."""
    a = factor.copy()
    n = a.shape[1]
    order = list(range(n)) + ([None] if n % 2 else [])
    half = len(order) // 2
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(max(1, len(order) - 1)):
            pairs = [(x, y) for x, y in zip(order[:half], order[:half - 1:-1]) if x is not None and y is not None]
            if pairs:
                i, j = np.array(pairs).T
                p, q = a[:, i], a[:, j]
                alpha, beta, gamma = (p * p).sum(0), (q * q).sum(0), (p * q).sum(0)
                scale = np.sqrt(alpha * beta)
                off = np.divide(np.abs(gamma), scale, out=np.zeros_like(gamma), where=scale > 0)
                worst = max(worst, float(off.max(initial=0.0)))
                turn = off > 1e-16
                zeta = (beta - alpha) / np.where(turn, 2 * gamma, 1.0)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                t = np.where(turn, t, 0.0)
                c = 1 / np.hypot(1.0, t)
                a[:, i], a[:, j] = c * p - c * t * q, c * t * p + c * q
            order = order[:1] + order[-1:] + order[1:-1]
        if worst < 1e-14:
            break
    e = (a * a).sum(0)
    rank = np.argsort(-e, kind="stable")
    rank = rank[e[rank] > 0]
    return e[rank], a[:, rank] / np.sqrt(e[rank])


def _summed(parts: DataFrame, width: int) -> np.ndarray:
    """Rows (line, values) summed per line by Spark, each line in one of as many tasks as there
    are lines at most; the driver receives one row per line."""
    def add(batches):
        total = {}
        for b in batches:
            values = b.column("values").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, width)
            for line, row in zip(b.column("line").to_pylist(), values):
                total[line] = total[line] + row if line in total else row.copy()
        yield pa.record_batch([pa.array(total.keys(), pa.int32()), pa.array([x.tolist() for x in total.values()], pa.list_(pa.float64()))],
                              names=["line", "values"])

    rows = parts.repartition("line").mapInArrow(add, "line int, values array<double>").collect()
    out = np.zeros((width, width))
    for r in rows:
        out[r["line"]] = r["values"]
    return out


class Whitening:
    """Fitted to all usable vectors of one table: the dimension is the length that most of
    them have (of equally many the larger); vectors of another length take no part."""

    def __init__(self, embeddings: DataFrame, components: int = COMPONENTS):
        vectors = usable_vectors(embeddings)
        lengths = vectors.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
        self.dim, self.n = (int(lengths["d"]), int(lengths["count"])) if lengths else (0, 0)
        self.vectors = vectors.where(F.size("v") == self.dim)
        self.sums = self._sums() if self.dim else []
        self.values, self.axes, self.trace, self.error = np.zeros(0), np.zeros((0, 0)), 0.0, 0.0
        if self.dim:
            scatter = _summed(self.vectors.select("v").mapInArrow(self._scatters(), "line int, values array<double>"), self.dim) / self.n
            self.trace = float(np.trace(scatter))
            factor = pivoted_cholesky(scatter)
            values, axes = one_sided_jacobi(factor)
            self.values, self.axes = values[:components], axes[:, :components]
        if len(self.values):
            self.error = self._identity_error()

    def _sums(self) -> list[int]:
        """Exact sums of x per dimension; a partition sends one row per dimension."""
        dim = self.dim

        def add(batches):
            total = np.zeros(dim, object)
            for b in batches:
                x = _longs(b.column("v"), dim)
                if len(x):  # longs unless their sum could overflow
                    total += x.sum(0) if int(np.abs(x).max()) * len(x) < LONG else x.astype(object).sum(0)
            yield pa.record_batch([pa.array(range(dim), pa.int32()), pa.array([str(x) for x in total])], names=["line", "total"])

        parts = self.vectors.select("v").mapInArrow(add, "line int, total string")
        got = parts.groupBy("line").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
        return [int(x) for _, x in sorted((r["line"], r["total"]) for r in got)]

    def _centre(self):
        """A function from x to n * x - S, exact: longs where they fit, else Python integers."""
        n, sums = self.n, self.sums
        mean = np.array([s // n for s in sums], np.int64)
        rest = np.array([s % n for s in sums], np.int64)

        def centred(x: np.ndarray) -> np.ndarray:
            near = x - mean
            if len(near) and int(np.abs(near).max()) * n >= LONG // 4:
                return near.astype(object) * n - rest.astype(object)
            return near * n - rest

        return centred

    def _scatters(self):
        centred, dim, n = self._centre(), self.dim, self.n

        def scatter(batches):
            total = np.zeros((dim, dim))
            for b in batches:
                z = centred(_longs(b.column("v"), dim)).astype(float) / n
                total += z.T @ z
            yield pa.record_batch([pa.array(range(dim), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["line", "values"])

        return scatter

    def _projection(self):
        """A function from n * x - S to whitened values."""
        axes, roots, n = self.axes, np.sqrt(self.values), self.n
        return lambda y: (y.astype(float) / n) @ axes / roots

    def _identity_error(self) -> float:
        """Largest absolute entry of the covariance of the whitened vectors less the identity."""
        centred, project, dim, k = self._centre(), self._projection(), self.dim, len(self.values)

        def gather(batches):  # one more line for the sums
            total = np.zeros((k + 1, k + 1))
            for b in batches:
                w = project(centred(_longs(b.column("v"), dim)))
                w1 = np.column_stack([w, np.ones(len(w))])
                total += w1.T @ w1
            yield pa.record_batch([pa.array(range(k + 1), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["line", "values"])

        total = _summed(self.vectors.select("v").mapInArrow(gather, "line int, values array<double>"), k + 1)
        mean = total[k, :k] / self.n  # of centred vectors: rounding only
        return float(np.abs(total[:k, :k] / self.n - np.outer(mean, mean) - np.eye(k)).max())

    def rows(self) -> DataFrame:
        centred, project, dim = self._centre() if self.dim else None, self._projection(), self.dim

        def whiten(batches):
            for b in batches:
                y = centred(_longs(b.column("v"), dim))
                if y.dtype != object and len(y) and int(np.abs(y).max()) ** 2 * dim < LONG:
                    deviation = (y * y).sum(1)
                else:
                    deviation = [s if s < LONG else None for s in (y.astype(object) ** 2).sum(1)] if len(y) else []
                yield pa.record_batch([b.column("vec_id"), pa.array(deviation, pa.int64()), pa.array(project(y).tolist(), pa.list_(pa.float64()))],
                                      names=["vec_id", "deviation", "w"])

        id_type = self.vectors.schema["vec_id"].dataType.simpleString()
        if len(self.values):
            out = self.vectors.mapInArrow(whiten, f"vec_id {id_type}, deviation long, w array<double>")
        else:
            out = self.vectors.where("false").select("vec_id", F.lit(0).cast("long").alias("deviation"), F.col("v").alias("w"))
        explained = F.array(*[F.lit(float(e / self.trace)) for e in self.values]) if len(self.values) else F.array().cast("array<double>")
        return out.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
            "vec_id", (F.col("at") + 1).alias("component"), F.lit(self.n).cast("long").alias("n"), "deviation", "whitened",
            F.get(explained, F.col("at")).alias("explained"), F.lit(self.error).alias("identity_error"))


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable vector
    and each of the first ``components`` components, fewer where the covariance has a
    smaller rank (none where all vectors are equal).

    Left out: vectors that are null, hold null or non-finite entries or entries of 2^52 or more, and those whose
    length is not the most frequent one (empty vectors among others). Repeated rows count and
    appear as often as they occur; a null vec_id stays null. ``deviation`` is null where it exceeds a
    long. Other columns are not read."""
    return Whitening(embeddings, components).rows()
