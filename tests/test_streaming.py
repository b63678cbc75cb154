import os

from conftest import ms
from pyspark.sql import functions as F
from rows import trades_a, trades_b

from tidemark import schemas
from tidemark.operators.double_bottom import double_bottom
from tidemark.sources import feeds
from tidemark.streaming import jobs
from tidemark.streaming.sinks import current_rows, write_batch

ONCE = {"availableNow": True}
T0 = ms("2024-01-01 00:00:00")


def _append(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def test_vwap_stream_drops_late_rows_and_open_window(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    _append(trades_a(spark, [("BTCUSDT", T0 + 1_000, 1, 100, 1), ("BTCUSDT", T0 + 320_000, 2, 200, 1)]), src)
    q = jobs.vwap_job(feeds.read_trades_a(spark, src, stream=True), out, checkpoint=ck, trigger=ONCE)
    q.awaitTermination()
    # watermark is now 320 s - 10 s: the first window [0, 300 s) is closed and written
    got = spark.read.parquet(out).collect()
    assert [(r.vwap, r.trade_count) for r in got] == [(100.0, 1)]
    # a late row for the closed window is dropped; a row far ahead closes the second window
    _append(trades_a(spark, [("BTCUSDT", T0 + 2_000, 3, 1, 1), ("BTCUSDT", T0 + 900_000, 4, 5, 1)]), src)
    q = jobs.vwap_job(feeds.read_trades_a(spark, src, stream=True), out, checkpoint=ck, trigger=ONCE)
    q.awaitTermination()
    got = sorted((r.window_start.minute, r.vwap) for r in spark.read.parquet(out).collect())
    assert got == [(0, 100.0), (5, 200.0)]


def test_restart_no_loss_no_duplicates(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    rows = [("BTCUSDT", T0 + i * 1000, i, 100, 6) for i in range(6)]
    _append(trades_a(spark, rows[:3]), src)
    b = trades_b(spark, [("BTC-USD", T0, 99, 100, 1)])
    b.write.parquet(os.path.join(tmp_dir, "b"))
    sb = feeds.read_trades_b(spark, os.path.join(tmp_dir, "b"), stream=True)
    q = jobs.whale_job(feeds.read_trades_a(spark, src, stream=True), sb, out, checkpoint=ck, trigger=ONCE)
    q.awaitTermination()
    _append(trades_a(spark, rows[3:]), src)
    q = jobs.whale_job(feeds.read_trades_a(spark, src, stream=True), sb, out, checkpoint=ck, trigger=ONCE)
    q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 6 and got.select("event_time").distinct().count() == 6


def test_same_batch_written_twice_is_idempotent(spark, tmp_dir):
    df = spark.createDataFrame([("BTCUSDT", 1.0)], "symbol string, v double")
    write_batch(df, 7, tmp_dir + "/t")
    write_batch(df, 7, tmp_dir + "/t")
    write_batch(df, 8, tmp_dir + "/t")
    assert spark.read.parquet(tmp_dir + "/t").count() == 2


def test_current_rows_view(spark, tmp_dir):
    from datetime import datetime
    t = datetime(2024, 1, 1)
    r1 = spark.createDataFrame([("BTCUSDT", 1.0, 1.0, 1.0, "binance", "BUY", t, 10)], schemas.WHALE_ALERTS.schema)
    r2 = spark.createDataFrame([("BTCUSDT", 2.0, 1.0, 2.0, "coinbase", "SELL", t, 10)], schemas.WHALE_ALERTS.schema)
    write_batch(r1, 1, tmp_dir + "/w")
    write_batch(r2, 2, tmp_dir + "/w")
    cur = current_rows(spark, tmp_dir + "/w", schemas.WHALE_ALERTS).collect()
    assert len(cur) == 1 and cur[0].exchange == "coinbase"


def test_arbitrage_stream_equals_batch(spark, tmp_dir):
    from tidemark.operators.interval_join import arbitrage_signals
    a_rows = [("BTCUSDT", T0 + i * 4000, i, 100 + (i % 5), 1) for i in range(30)]
    b_rows = [("BTC-USD", T0 + i * 3000 + 500, i, 100 + (i % 7), 1) for i in range(40)]
    pa, pb = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    for lo in range(0, 120_001, 40_000):
        _append(trades_a(spark, [r for r in a_rows if lo <= r[1] - T0 < lo + 40_000]), pa)
        _append(trades_b(spark, [r for r in b_rows if lo <= r[1] - T0 < lo + 40_000]), pb)
    sa = feeds.read_trades_a(spark, pa, stream=True, max_files_per_trigger=1)
    sb = feeds.read_trades_b(spark, pb, stream=True, max_files_per_trigger=1)
    q = jobs.arbitrage_job(sa, sb, os.path.join(tmp_dir, "out"), checkpoint=os.path.join(tmp_dir, "ck"), trigger=ONCE)
    q.awaitTermination()
    got = spark.read.parquet(os.path.join(tmp_dir, "out"))
    exp = arbitrage_signals(trades_a(spark, a_rows), trades_b(spark, b_rows))
    assert got.count() == exp.count() > 0


def test_double_bottom_stream_out_of_order_equals_batch(spark, tmp_dir):
    import random
    rnd = random.Random(7)
    p, rows = 100, []
    for i in range(120):
        p += rnd.choice([-2, -1, 0, 1, 2])
        rows.append(("X" if i % 3 else "Y", T0 + i * 2000, i, p, 1))
    src = os.path.join(tmp_dir, "in")
    # chunks of 20 s, shuffled inside each chunk (out of order within the 10 s... delay window)
    for lo in range(0, 240_000, 20_000):
        chunk = [r for r in rows if lo <= r[1] - T0 < lo + 20_000]
        rnd.shuffle(chunk)
        if chunk:
            _append(trades_a(spark, chunk), src)
    s = feeds.read_trades_a(spark, src, stream=True, max_files_per_trigger=1)
    q = jobs.double_bottom_job(s, os.path.join(tmp_dir, "out"), checkpoint=os.path.join(tmp_dir, "ck"),
                               within_ms=60_000, watermark="0 seconds", trigger=ONCE)
    q.awaitTermination()
    got = sorted((r.symbol, r.first_dip, r.breakout_price, int(r.confirmed_at.timestamp()))
                 for r in spark.read.parquet(os.path.join(tmp_dir, "out")).collect())
    last = max(r[1] for r in rows)
    exp = sorted((r.symbol, r.first_dip, r.breakout_price, r.confirmed_at_ms // 1000)
                 for r in double_bottom(trades_a(spark, rows), within_ms=60_000).collect()
                 if r.confirmed_at_ms < last)
    assert got == exp and len(exp) > 0


def test_double_bottom_stream_next_row_equals_batch(spark, tmp_dir):
    import random
    rnd = random.Random(11)
    p, rows = 100, []
    for i in range(90):
        p += rnd.choice([-2, -1, 1, 2])
        rows.append(("X", T0 + i * 3000, i, p, 1))
    src = os.path.join(tmp_dir, "in")
    for lo in range(0, 270_000, 30_000):
        _append(trades_a(spark, [r for r in rows if lo <= r[1] - T0 < lo + 30_000]), src)
    s = feeds.read_trades_a(spark, src, stream=True, max_files_per_trigger=1)
    q = jobs.double_bottom_job(s, os.path.join(tmp_dir, "out"), checkpoint=os.path.join(tmp_dir, "ck"),
                               within_ms=45_000, after_match="next_row", watermark="0 seconds", trigger=ONCE)
    q.awaitTermination()
    got = sorted((r.first_dip, r.second_dip, r.breakout_price, int(r.confirmed_at.timestamp()))
                 for r in spark.read.parquet(os.path.join(tmp_dir, "out")).collect())
    last = max(r[1] for r in rows)
    exp = sorted((r.first_dip, r.second_dip, r.breakout_price, r.confirmed_at_ms // 1000)
                 for r in double_bottom(trades_a(spark, rows), within_ms=45_000, after_match="next_row").collect()
                 if r.confirmed_at_ms < last)
    assert got == exp and len(exp) > 0


def test_failure_inside_a_batch_then_restart(spark, tmp_dir):
    """The sink fails after writing part of a batch; the restarted query
    replays that batch and its partition is replaced: no loss, no duplicates."""
    import pytest
    from tidemark.operators.whales import whale_alert_rows, whale_trades
    from tidemark.streaming.sinks import result_table_writer

    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    _append(trades_a(spark, [("BTCUSDT", T0 + i * 1000, i, 100, 6) for i in range(4)]), src)
    b = trades_b(spark, [("BTC-USD", T0, 99, 100, 1)])
    b.write.parquet(os.path.join(tmp_dir, "b"))
    good = result_table_writer(out, schemas.WHALE_ALERTS)

    def failing(df, batch_id):
        good(df.limit(1), batch_id)        # part of the batch reaches the table
        raise RuntimeError("sink failure")

    def start(writer):
        rows = whale_alert_rows(whale_trades(feeds.read_trades_a(spark, src, stream=True),
                                             feeds.read_trades_b(spark, os.path.join(tmp_dir, "b"), stream=True)))
        return (rows.writeStream.foreachBatch(writer).option("checkpointLocation", ck)
                    .trigger(availableNow=True).start())

    q = start(failing)
    with pytest.raises(Exception):
        q.awaitTermination()
    assert spark.read.parquet(out).count() == 1
    start(good).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 4 and got.select("event_time").distinct().count() == 4


def test_ingest_output_feeds_the_vwap_job(spark, tmp_dir):
    """Raw messages -> ingest job -> typed trades folder -> VWAP job."""
    trade = ('{{"stream":"btcusdt@trade","data":{{"e":"trade","E":{t},"s":"BTCUSDT","t":{i},'
             '"p":"{p}","q":"1","T":{t},"m":false,"M":true}}}}')
    msgs = [(trade.format(t=T0 + i * 60_000, i=i, p=100 + i), T0 + i * 60_000 + 5) for i in range(12)]
    msgs.append(("{broken", T0))
    raw = os.path.join(tmp_dir, "raw")
    spark.createDataFrame(msgs, "value string, received_at long").coalesce(1).write.parquet(raw)
    q = jobs.ingest_job(feeds.read_raw(spark, raw, stream=True), "a", os.path.join(tmp_dir, "ing"),
                        checkpoint=os.path.join(tmp_dir, "ck1"), trigger=ONCE)
    q.awaitTermination()
    assert spark.read.parquet(os.path.join(tmp_dir, "ing", "dead_letter_a")).count() == 1
    typed = feeds.read_trades_a(spark, os.path.join(tmp_dir, "ing", "trades_a"), stream=True)
    q = jobs.vwap_job(typed, os.path.join(tmp_dir, "vwap"), checkpoint=os.path.join(tmp_dir, "ck2"), trigger=ONCE)
    q.awaitTermination()
    got = sorted((r.window_start.minute, r.vwap, r.trade_count)
                 for r in spark.read.parquet(os.path.join(tmp_dir, "vwap")).collect())
    # windows [0,5) and [5,10) are closed by the watermark (last row at minute 11); [10,15) is open
    assert got == [(0, 102.0, 5), (5, 107.0, 5)]


def test_double_bottom_stream_with_nulls_equals_batch(spark, tmp_dir):
    """Null ids sort first among equal times, a null price ends a run, rows without a time are left out."""
    import random
    rnd = random.Random(3)
    p, rows = 100, []
    for i in range(150):
        p += rnd.choice([-2, -1, 1, 2])
        rows.append(("X", T0 + (i - i % 2) * 2000, None if i % 2 else i, None if i % 23 == 22 else p, 1))
    src = os.path.join(tmp_dir, "in")
    for lo in range(0, 300_000, 30_000):
        _append(trades_a(spark, [r for r in rows if lo <= r[1] - T0 < lo + 30_000]), src)
    _append(trades_a(spark, [("X", 0, 1, 1, 1)]).withColumn("trade_time", F.lit(None).cast("long")), src)
    s = feeds.read_trades_a(spark, src, stream=True, max_files_per_trigger=1)
    q = jobs.double_bottom_job(s, os.path.join(tmp_dir, "out"), checkpoint=os.path.join(tmp_dir, "ck"),
                               within_ms=60_000, watermark="0 seconds", trigger=ONCE)
    q.awaitTermination()
    got = sorted((r.first_dip, r.second_dip, r.breakout_price, int(r.confirmed_at.timestamp()))
                 for r in spark.read.parquet(os.path.join(tmp_dir, "out")).collect())
    last = max(r[1] for r in rows)
    exp = sorted((r.first_dip, r.second_dip, r.breakout_price, r.confirmed_at_ms // 1000)
                 for r in double_bottom(trades_a(spark, rows), within_ms=60_000).collect() if r.confirmed_at_ms < last)
    assert got == exp and len(exp) > 2
