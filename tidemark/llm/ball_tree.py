"""Exact top-k inner products by ball-tree branch and bound per shard.

Vectors are dealt to shards of about ``SHARD_ROWS`` rows by direction (the nearest of a few sampled
vectors), so that a shard's root ball is small; each shard becomes one row that holds its
ball tree. Queries are dealt to blocks of about ``BLOCK_ROWS`` in the same way. A block first searches one shard
of its own direction, which gives every query a current kth score. With these scores the root balls of all other
shards are tested: a query goes on to a shard only if the root's upper bound reaches its kth score. The
same bound, q.c + |q| r, then leaves out nodes inside the shard, which are visited by falling bound, so that
the kth score rises early. Only rows that reach the shared score leave a shard.

A tree moves once per search to the tasks of its shard; what moves per pair of block and shard are the queries
that are left. Every task is of bounded size. Scores are integers and exact; bounds get a margin above rounding.
"""

from __future__ import annotations

import heapq
import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import pieces_of
from tidemark.session import delete_path, materialize, scratch_path

SHARD_ROWS = 16384
BLOCK_ROWS = 2048
LEAF_ROWS = 128
PIVOTS = 256  # directions that vectors are dealt by, at most
ROOTS = 4096  # root balls that a block is tested against at once
NONE = np.iinfo(np.int64).min + 1  # its negation is a long too


def quantised(vectors: DataFrame, vec: str = "embedding", scale: int = 64) -> DataFrame:
    """(vec_id, q): floor(scale * x) of each component x as double. Rows whose id
    is null, or whose vector is null, empty or holds a null or non-finite component, take no part."""
    x = F.col(vec)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return (vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~F.coalesce(bad, F.lit(True)))
            .select("vec_id", F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("q")))


class BallTree:
    """Integer vectors in leaves of at most ``leaf`` rows; each node has a centre
    and a radius. Rows are split at the median along the direction between two far points."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF_ROWS):
        self.nodes = []  # (first row, last row, left child, right child)
        centres, radii = [], []
        order, x = np.arange(len(ids)), rows.astype(np.float64)

        def build(a: int, b: int) -> int:
            part = x[order[a:b]]
            centre = part.mean(0)
            at = len(self.nodes)
            self.nodes.append(None)
            centres.append(centre)
            far = ((part - centre) ** 2).sum(1)
            radii.append(math.sqrt(far.max()) * (1 + 1e-9))
            if b - a <= leaf:
                self.nodes[at] = (a, b, -1, -1)
                return at
            one = part[far.argmax()]
            other = part[((part - one) ** 2).sum(1).argmax()]
            mid = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(part @ (other - one), mid)]
            self.nodes[at] = (a, b, build(a, a + mid), build(a + mid, b))
            return at

        if len(ids):
            build(0, len(ids))
        self.ids, self.rows = ids[order], rows[order]
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.largest = int(np.abs(rows).max(initial=0))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray):
        """(query place, id, score) arrays: for each query at least those of its k best
        rows (ties by id) that score ``floor`` or more, never the row with the query's id."""
        n = len(query_ids)
        top = int(np.abs(queries).max(initial=0))
        if top * self.largest * queries.shape[1] >= 2 ** 63:
            raise OverflowError("an inner product of these vectors may exceed a long")
        exact = top * self.largest * queries.shape[1] < 2 ** 53  # doubles hold the scores, and multiply fast
        kind = np.float64 if exact else np.int64
        q = queries.astype(kind)
        norms = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
        bounds = queries.astype(np.float64) @ self.centres.T + norms[:, None] * self.radii
        bounds += 1 + np.abs(bounds) * 1e-9
        scores = np.full((n, k), NONE, np.int64)
        ids = np.full((n, k), np.iinfo(np.int64).max, np.int64)
        kth = floor.copy()
        heap = [(-bounds[:, 0].max(), 0)]
        while heap:
            _, node = heapq.heappop(heap)
            live = np.flatnonzero(bounds[:, node] >= kth)
            if not len(live):
                continue
            a, b, left, right = self.nodes[node]
            if left >= 0:
                for child in (left, right):
                    heapq.heappush(heap, (-bounds[live, child].max(), child))
                continue
            got = (q[live] @ self.rows[a:b].astype(kind).T).astype(np.int64)
            got[query_ids[live][:, None] == self.ids[a:b][None, :]] = NONE
            better = np.flatnonzero(got.max(1) >= kth[live])
            if not len(better):
                continue
            at = live[better]
            all_s = np.concatenate([scores[at], got[better]], 1)
            all_i = np.concatenate([ids[at], np.broadcast_to(self.ids[a:b], (len(at), b - a))], 1)
            best = np.lexsort((all_i, -all_s), axis=1)[:, :k]
            scores[at], ids[at] = np.take_along_axis(all_s, best, 1), np.take_along_axis(all_i, best, 1)
            kth[at] = np.maximum(floor[at], scores[at, -1])
        of, place = np.nonzero((scores > NONE) & (scores >= floor[:, None]))
        return of, ids[of, place], scores[of, place]


def _matrix(batch) -> np.ndarray:
    col = batch.column("q").combine_chunks()
    flat = np.asarray(col.flatten())
    if len(col) and len(flat) % len(col):
        raise ValueError("vectors of different lengths")
    return flat.reshape(len(col), -1)


def _per_piece(rows: DataFrame, make, more: str = "") -> DataFrame:
    """(at, blob, ...) with one row for each piece: ``make(ids, matrix)`` gives what is pickled and further columns."""
    def build(t: pa.Table) -> pa.Table:
        held, extra = make(np.asarray(t.column("vec_id")), _matrix(t))
        blob = pickle.dumps(held, protocol=5)
        return pa.table({"at": t.column("at").slice(0, 1), "blob": pa.array([blob], pa.binary()), **extra})

    return rows.select("at", "vec_id", "q").groupBy("at").applyInArrow(build, "at int, blob binary" + more)


def _tree(ids: np.ndarray, rows: np.ndarray):
    tree = BallTree(ids, rows)
    return tree, {"centre": pa.array([tree.centres[0].tolist()], pa.list_(pa.float64())), "radius": pa.array([tree.radii[0]])}


def _directed(rows: DataFrame, n_pieces: int) -> DataFrame:
    """``rows`` with ``pivot``, the place of the sampled vector of the nearest direction (0 for a zero vector)."""
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(min(PIVOTS, n_pieces)).select("q").collect()  # at most PIVOTS vectors
    if len({len(r["q"]) for r in sample}) > 1:
        raise ValueError("vectors of different lengths")
    pivots = np.array([r["q"] for r in sample], float)
    pivots /= np.maximum(np.sqrt((pivots ** 2).sum(1, keepdims=True)), 1e-300)

    def nearest(batches):
        for b in batches:
            if b.num_rows:
                place = (_matrix(pa.Table.from_batches([b])).astype(float) @ pivots.T).argmax(1)
                yield pa.record_batch([*b.columns, pa.array(place.astype(np.int32))], names=["vec_id", "q", "pivot"])

    return rows.select("vec_id", "q").mapInArrow(nearest, "vec_id long, q array<long>, pivot int")


def _dealt(rows: DataFrame, counts: dict[int, int], per: int, salt: int) -> tuple[DataFrame, dict[int, tuple[int, int]], int]:
    """``rows`` with ``at``, a piece of about ``per`` rows of one pivot; the first piece and the pieces of
    each pivot; the number of pieces."""
    pieces, total = {}, 0
    for pivot in sorted(counts):
        pieces[pivot] = (total, pieces_of(counts[pivot], per))
        total += pieces[pivot][1]
    at = lambda k: F.element_at(F.array(*[F.lit(pieces.get(p, (0, 1))[k]) for p in range(max(pieces) + 1)]), F.col("pivot") + 1)
    return rows.withColumn("at", (at(0) + F.pmod(F.xxhash64("vec_id", F.lit(salt)), at(1))).cast("int")), pieces, total


def _search(trees: DataFrame, pairs: DataFrame, k: int, copies: int, tasks: int) -> DataFrame:
    """Search of ``pairs`` (shard, block_no, blob of the queries: ids, vectors, places, current kth scores). A shard's tree
    and its pairs meet in ``copies`` tasks, the tree ahead of the pairs."""
    shard_trees = (trees.select(F.col("at").alias("shard"), F.lit(-1).alias("block_no"), "blob")
                   .join(pairs.select("shard").distinct(), "shard", "left_semi")
                   .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))))
    asked = pairs.select("shard", "block_no", "blob", F.pmod(F.xxhash64("block_no"), F.lit(copies)).cast("int").alias("copy"))
    rows = (shard_trees.unionByName(asked).repartition(tasks, "shard", "copy").sortWithinPartitions("shard", "copy", "block_no"))

    def run(batches):
        tree = None
        for b in batches:
            for block, blob in zip(b.column("block_no").to_pylist(), b.column("blob")):
                if block < 0:
                    tree = pickle.loads(blob.as_py())
                    continue
                ids, queries, place, floor = pickle.loads(blob.as_py())
                of, found, score = tree.search(ids, queries, k, floor)
                yield pa.record_batch([pa.array(ids[of]), pa.array(np.full(len(of), block, np.int32)), pa.array(place[of].astype(np.int32)), pa.array(found),
                                       pa.array(score)], names=["query_id", "block_no", "place", "vec_id", "score"])

    return rows.select("block_no", "blob").mapInArrow(run, "query_id long, block_no int, place int, vec_id long, score long")


def _reached(blocks: DataFrame, roots: DataFrame) -> DataFrame:
    """(shard, block_no, blob): for each block (block_no, home, blob, known: kth scores by place) the queries that
    can still find something in a shard other than ``home``. ``roots``: (part, root balls of at most ``ROOTS`` shards)."""
    def test(batches):
        for b in batches:
            for block, home, blob, known, part in zip(*(b.column(c) for c in ("block_no", "home", "blob", "known", "balls"))):
                ids, queries, place, floor = pickle.loads(blob.as_py())
                for f in known.as_py() or []:
                    floor[f["place"]] = f["kth"]
                shards, centres, radii = pickle.loads(part.as_py())
                q = queries.astype(float)
                bounds = q @ centres.T + np.sqrt((q ** 2).sum(1))[:, None] * radii
                bounds += 1 + np.abs(bounds) * 1e-9
                live = bounds >= floor[:, None]
                live[:, shards == home.as_py()] = False
                for j in np.flatnonzero(live.any(0)):
                    of = live[:, j]
                    left = pickle.dumps((ids[of], queries[of], place[of], floor[of]), protocol=5)
                    yield pa.record_batch([pa.array([shards[j]], pa.int32()), pa.array([block.as_py()], pa.int32()), pa.array([left], pa.binary())],
                                          names=["shard", "block_no", "blob"])

    return (blocks.join(roots, "part").select("block_no", "home", "blob", "known", "balls")
            .mapInArrow(test, "shard int, block_no int, blob binary"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, vec: str = "embedding", scale: int = 64) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest integer inner products
    of each query with every row but its own, ties to the smaller vec_id; all if there are fewer.

    ``vec_id`` names a vector: of rows with one id the vector that sorts first
    counts. See ``quantised`` for the rows that take no part. Intermediate tables are deleted, the result is stored."""
    spark = vectors.sparkSession
    paths: list[str] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        paths.append(scratch_path(spark, name))
        return materialize(df, name, paths[-1])

    try:
        ready = keep(quantised(vectors, vec, scale).groupBy("vec_id").agg(F.min("q").alias("q")), "vectors")
        n = ready.count()
        if not n:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
        dealt = keep(_directed(ready, pieces_of(n, SHARD_ROWS)).withColumn("asks", F.coalesce(is_query, F.lit(False))), "directed")
        counts = dealt.groupBy("pivot").agg(F.count("*").alias("n"), F.sum(F.col("asks").cast("long")).alias("q")).collect()  # a row per pivot
        asked = {r["pivot"]: r["q"] for r in counts if r["q"]}
        if not asked:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
        rows, shards_of, n_shards = _dealt(dealt, {r["pivot"]: r["n"] for r in counts}, SHARD_ROWS, 1)
        queries, blocks_of, n_blocks = _dealt(dealt.where("asks"), asked, BLOCK_ROWS, 2)
        trees = keep(_per_piece(rows, _tree, ", centre array<double>, radius double"), "ball-trees")
        blocks = keep(_per_piece(queries, lambda ids, q: ((ids, q, np.arange(len(ids)), np.full(len(ids), NONE, np.int64)), {})), "query-blocks")
        # a block's home: a shard of its pivot
        home = {first + j: shards_of[p][0] + j % shards_of[p][1] for p, (first, pieces) in blocks_of.items() for j in range(pieces)}
        homes = spark.createDataFrame(list(home.items()), "at int, home int")  # a row per block
        blocks = blocks.join(homes, "at").withColumnRenamed("at", "block_no")
        width = 2 * spark.sparkContext.defaultParallelism
        copies, tasks = max(1, min(n_blocks, -(-width // n_shards))), max(width, min(n_shards, 4096))
        first = keep(_search(trees, blocks.select(F.col("home").alias("shard"), "block_no", "blob"), k, copies, tasks), "home-shards")
        by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        kth = first.withColumn("r", F.row_number().over(by_query)).where(F.col("r") == k)
        known = kth.groupBy("block_no").agg(F.collect_list(F.struct("place", F.col("score").alias("kth"))).alias("known"))  # at most a block
        balls = (trees.select("at", "centre", "radius", F.floor(F.col("at") / ROOTS).cast("int").alias("part"))
                 .groupBy("part").applyInArrow(_packed_roots, "part int, balls binary"))
        parts = F.explode(F.sequence(F.lit(0), F.lit((n_shards - 1) // ROOTS)))
        pairs = keep(_reached(blocks.join(known, "block_no", "left").withColumn("part", parts), balls), "reached-shards")
        found = first.unionByName(_search(trees, pairs, k, copies, tasks))
        path = scratch_path(spark, "top-k")
        return materialize(found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
                           .select("query_id", "rank", "vec_id", "score"), "top-k", path)
    finally:
        for path in paths:
            delete_path(spark, path)


def _packed_roots(t: pa.Table) -> pa.Table:
    centres = np.array(t.column("centre").to_pylist(), float)
    blob = pickle.dumps((np.asarray(t.column("at")), centres, np.asarray(t.column("radius"))), protocol=5)
    return pa.table({"part": t.column("part").slice(0, 1), "balls": pa.array([blob], pa.binary())})
