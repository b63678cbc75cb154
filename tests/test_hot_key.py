"""One symbol holding every row must not be processed by a single task."""

from conftest import ms
from pyspark.sql import functions as F
from rows import trades_a, trades_b

from tidemark.operators import double_bottom as D
from tidemark.operators.interval_join import interval_join

T0 = ms("2024-01-01 00:00:00")


def _no_coalesce(spark):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    return old


def test_pattern_rows_spread_over_tasks(spark):
    old = _no_coalesce(spark)
    try:
        rows = [("BTCUSDT", T0 + i * 60_000, i, 100 + (i * 7919) % 13, 1) for i in range(3000)]  # 50 hours
        nb = D._with_neighbours(D._rows(trades_a(spark, rows), "trade_time", "price", "trade_id", "symbol",
                                        D.DEFAULT_BUCKET_MS))
        parts = nb.select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_interval_join_spreads_one_symbol(spark):
    old = _no_coalesce(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = trades_a(spark, [("BTCUSDT", T0 + i * 5_000, i, 100, 1) for i in range(2000)])
        b = trades_b(spark, [("BTC-USD", T0 + i * 5_000 + 1, i, 100, 1) for i in range(2000)])
        j = interval_join(a, b)
        parts = j.select(F.spark_partition_id().alias("p")).distinct().count()
        # partners at j - i in {-2, -1, 0, 1} (b is 1 ms later); 4 lost at the two ends
        assert parts > 1 and j.count() == 2000 * 4 - 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pattern_time_is_linear_in_the_rows_of_a_bucket(spark):
    """200,000 rows of one symbol in one hour bucket against the same rows over
    50 buckets. (Frames that run to the end of a bucket took minutes here.)"""
    import time

    def seconds(step_ms):
        # 18 ms apart: all in one hour; 900 ms apart: 50 hours
        rows = spark.range(200_000).select(
            F.lit("BTCUSDT").alias("symbol"), (F.lit(T0) + F.col("id") * step_ms).alias("ts"), F.col("id").alias("tid"),
            (100 + F.pmod(F.xxhash64("id"), F.lit(50))).cast("double").alias("price"))
        rows = rows.withColumn("bucket", F.floor(F.col("ts") / D.DEFAULT_BUCKET_MS))
        began = time.time()
        D._with_neighbours(rows).write.format("noop").mode("overwrite").save()
        return time.time() - began

    seconds(900)  # compiled and warm
    many, one = seconds(900), seconds(18)
    assert one < 10 * many + 5


def test_no_frame_runs_to_the_end(spark):
    rows = D._rows(trades_a(spark, [("BTCUSDT", T0, 1, 100, 1)]), "trade_time", "price", "trade_id", "symbol", D.DEFAULT_BUCKET_MS)
    nb = D._with_neighbours(rows)
    for df in (nb, D._tail_map(D._segments(nb))):
        assert "unboundedfollowing" not in df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_interval_join_spreads_pairs_of_small_tables(spark, tmp_dir):
    """Two feeds far below the broadcast limit with far more pairs than rows: the pairs must not
    all come from the one task that reads a feed."""
    old = _no_coalesce(spark)
    try:
        a = trades_a(spark, [("BTCUSDT", T0 + i * 50, i, 100, 1) for i in range(1500)]).coalesce(1)
        b = trades_b(spark, [("BTC-USD", T0 + i * 50 + 1, i, 100, 1) for i in range(1500)]).coalesce(1)
        a.write.parquet(tmp_dir + "/a")
        b.write.parquet(tmp_dir + "/b")
        j = interval_join(spark.read.parquet(tmp_dir + "/a"), spark.read.parquet(tmp_dir + "/b"))
        by_task = [r["count"] for r in j.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        # b is 1 ms later: partners at j - i from -200 to 199
        assert sum(by_task) == sum(1500 - abs(d) for d in range(-200, 200))
        assert len(by_task) > 1 and max(by_task) < 0.8 * sum(by_task)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_no_pair_goes_through_a_decimal(spark):
    """r6 gives what round(x * 1e6, 0) / 1e6 gives, ties, zeros, infinities and nulls included, without
    the decimal that ``round`` makes of every double."""
    import random

    from tidemark.plans.queries import r6

    rnd = random.Random(3)
    xs = [0.0, -0.0, -1e-9, 5e-7, -5e-7, 1.5e-6, 2.5e-6, -2.5e-6, 1e300, 1e17, float("inf"), float("-inf"), float("nan"), None]
    xs += [rnd.randint(-10**9, 10**9) / 2e6 for _ in range(2000)] + [rnd.uniform(-1e6, 1e6) for _ in range(2000)]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(
        r6("x").cast("string").alias("got"), (F.round(F.col("x") * 1e6, 0) / 1e6).cast("string").alias("want"))
    assert [r for r in got.collect() if r.got != r.want] == []
    assert "round(" not in got.select("got")._jdf.queryExecution().optimizedPlan().toString().lower()
