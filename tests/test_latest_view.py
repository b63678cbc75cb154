"""Changes of the current row per key on a stream, newest alerts of a stored table, latency sketches."""

import bisect
import os
import random
from datetime import datetime, timedelta

import pytest
from conftest import ms
from pyspark.sql import functions as F
from rows import trades_a

from tidemark import schemas
from tidemark.operators import ingest, reads
from tidemark.operators.latest import latest_by_key
from tidemark.streaming import jobs, sinks

T0 = datetime(2024, 1, 1)
TABLE = schemas.WHALE_ALERTS
ONCE = {"availableNow": True}


def _alert(symbol, second, price, version):
    return (symbol, float(price), 1.0, float(price), "binance", "BUY", T0 + timedelta(seconds=second), version)


def _view(df):
    return sorted((r.symbol, r.event_time, r.price, r.version) for r in df.collect())


def _start(spark, src, out, ck, **kw):
    stream = spark.readStream.schema(TABLE.schema).parquet(src)
    jobs.latest_job(stream, TABLE, out, checkpoint=ck, trigger=ONCE, **kw).awaitTermination()


def test_view_equals_the_batch_view_after_each_batch(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    r, seen = random.Random(5), []
    for batch in range(4):  # a restart each time
        rows = [_alert(r.choice("AB"), r.randrange(6), r.randint(1, 3), r.randint(1, 4)) for _ in range(12)]
        seen += rows
        spark.createDataFrame(rows, TABLE.schema).coalesce(1).write.mode("append").parquet(src)
        _start(spark, src, out, ck)
        want = latest_by_key(spark.createDataFrame(seen, TABLE.schema), TABLE.key)
        assert _view(sinks.current_rows(spark, out, TABLE)) == _view(want)


def test_only_changes_are_written(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    for rows in ([_alert("A", 1, 5, 3), _alert("B", 1, 7, 3)],
                 [_alert("A", 1, 9, 2), _alert("B", 1, 7, 3)],   # an older version, a repeated row
                 [_alert("A", 1, 4, 4), _alert("A", 2, 1, 1)]):
        spark.createDataFrame(rows, TABLE.schema).coalesce(1).write.mode("append").parquet(src)
        _start(spark, src, out, ck)
    got = sorted((r.batch_id, r.symbol, r.price) for r in spark.read.parquet(out).collect())
    first = [g[1:] for g in got[:2]]
    assert first == [("A", 5.0), ("B", 7.0)] and sorted(g[1:] for g in got[2:]) == [("A", 1.0), ("A", 4.0)]


def test_keys_are_forgotten_after_their_time(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    for rows in ([_alert("A", 0, 5, 1)], [_alert("A", 7200, 6, 1)], [_alert("A", 7260, 6, 1)], [_alert("A", 0, 8, 9)]):
        spark.createDataFrame(rows, TABLE.schema).coalesce(1).write.mode("append").parquet(src)
        _start(spark, src, out, ck, ttl="1 hour")
    state = spark.read.format("statestore").load(ck)
    assert {r.s for r in state.select(F.col("key.event_time").alias("s")).collect()} == {T0 + timedelta(seconds=7200), T0 + timedelta(seconds=7260)}
    assert len(_view(sinks.current_rows(spark, out, TABLE))) == 3  # the row for the forgotten key came too late
    assert _view(sinks.current_rows(spark, out, TABLE))[0][2] == 5.0


@pytest.mark.parametrize("n", [1, 3, 7, 100])
def test_newest_alerts_open_the_newest_dates(spark, tmp_dir, monkeypatch, n):
    path = tmp_dir + "/t"
    rows = [_alert(s, d * 86_400 + i * 100, 10 * d + i, 1) for d in range(6) for i in range(3) for s in "AB"]
    sinks.write_batch(spark.createDataFrame(rows, TABLE.schema), 0, path, TABLE.time)
    sinks.write_batch(spark.createDataFrame([_alert("A", 5 * 86_400, 99, 2), _alert("A", 200, 77, 2)], TABLE.schema), 1, path, TABLE.time)
    start, end = datetime(2024, 1, 1, 0, 1), datetime(2024, 1, 6, 0, 2)  # of the last date: seconds 0 and 100
    opened, of_dates = [], reads._of_dates
    monkeypatch.setattr(reads, "_of_dates", lambda s, p, t, dates: (opened.append(list(dates)), of_dates(s, p, t, dates))[1])
    got = reads.stored_recent_alerts(spark, path, start, end, n=n)
    whole = reads.top_recent_alerts(sinks.current_rows(spark, path, TABLE), F.lit(start), F.lit(end), n=n)
    listed = lambda df: [(r.event_time, r.symbol, r.price) for r in df.collect()]
    assert listed(got) == listed(whole)
    assert opened[-1] == [f"2024-01-0{6 - k}" for k in range({1: 1, 3: 1, 7: 2, 100: 6}[n])] and opened[:-1] == [[d] for d in opened[-1]]


def test_newest_alerts_of_nothing(spark, tmp_dir):
    path = tmp_dir + "/t"
    sinks.write_batch(spark.createDataFrame([_alert("A", 0, 1, 1)], TABLE.schema), 0, path, TABLE.time)
    assert reads.stored_recent_alerts(spark, path, datetime(2025, 1, 1), datetime(2025, 1, 2)).count() == 0


def test_latency_quantiles_within_their_bound(spark):
    """Sketches per hour and symbol, merged: ranks off by a small part of all trades, exact below k."""
    start = ms("2024-01-01 00:00:00")
    n = 30_000
    df = (spark.range(n).select(F.lit("BTCUSDT").alias("symbol"), (F.lit(start) + F.col("id") * 700).alias("trade_time"),
                                (F.pmod(F.hash("id"), 5000) * F.pmod(F.hash("id"), 7)).cast("long").alias("lag"))
          .withColumn("ingestion_time", F.col("trade_time") + F.col("lag")))
    exact = sorted(r.lag for r in df.select("lag").collect())
    for k in (256, 1024):
        sketches = ingest.latency_sketches(df, k=k)
        assert sketches.count() == 6
        (r,) = ingest.latency_quantiles(sketches, (0.5, 0.9, 0.99), k=k).collect()
        assert (r.symbol, r.exchange, r.trades) == ("BTCUSDT", "binance", n)
        for q, got in ((0.5, r.p50), (0.9, r.p90), (0.99, r.p99)):
            low, high = bisect.bisect_left(exact, got) / n, bisect.bisect_right(exact, got) / n
            assert low - 3 / k <= q <= high + 3 / k
    small = df.limit(500)
    values = sorted(r.lag for r in small.select("lag").collect())
    (r,) = ingest.latency_quantiles(ingest.latency_sketches(small)).collect()
    assert r.p50 == values[249] and r.p99 == values[494]
    plan = ingest.latency_sketches(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_kll" in plan.lower()


def test_latency_of_nothing(spark):
    assert ingest.latency_quantiles(ingest.latency_sketches(trades_a(spark, [("A", 1, 1, 1, 1)]).limit(0))).count() == 0
