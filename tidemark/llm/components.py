"""Connected components of an edge table, by alternating large and small stars.

Each step replaces edges by edges to smaller neighbours and writes the result to
the shared folder; nothing is gathered on the driver but two numbers per step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import delete_path, scratch_path


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (long columns a, b): root is the
    smallest node that it reaches. Nodes without edges do not appear."""
    spark = edges.sparkSession

    def stored(df):
        path = scratch_path(spark, "stars")
        df.write.parquet(path)
        return path, spark.read.parquet(path)

    def state(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    path, now = stored(_small_star(edges))
    before = state(now)
    while before[0]:
        next_path, now = stored(_small_star(_large_star(now)))
        delete_path(spark, path)
        path, after = next_path, state(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
