from conftest import ms
from pyspark.sql import functions as F
from rows import trades_a

from tidemark.operators.vwap import batch_vwap_by_hour, batch_vwap_range, vwap_by_window, vwap_rows


def test_vwap_window_edges_and_counts(spark):
    t0 = ms("2024-01-01 00:00:00")
    df = trades_a(spark, [
        ("BTCUSDT", t0 + 1_000, 1, 100, 1),
        ("BTCUSDT", t0 + 2_000, 2, 200, 3),
        ("BTCUSDT", t0 + 300_000, 3, 50, 2),      # exactly on the edge: later window
        ("ETHUSDT", t0 + 10_000, None, 10, 1),    # null id: not counted
        ("ETHUSDT", t0 + 11_000, 5, 20, 1),
    ])
    out = {(r.symbol, r.window_start.isoformat()): r for r in vwap_by_window(df).collect()}
    w0 = out[("BTCUSDT", "2024-01-01T00:00:00")]
    assert abs(w0.vwap - (100 * 1 + 200 * 3) / 4) < 1e-12
    assert w0.total_volume == 4 and w0.trade_count == 2 and w0.interval_label == "5m"
    w1 = out[("BTCUSDT", "2024-01-01T00:05:00")]
    assert w1.vwap == 50 and w1.trade_count == 1
    e = out[("ETHUSDT", "2024-01-01T00:00:00")]
    assert e.trade_count == 1 and e.vwap == 15


def test_zero_volume_gives_null(spark):
    t0 = ms("2024-01-01 00:00:00")
    df = trades_a(spark, [("BTCUSDT", t0, 1, 100, 0)])
    r = vwap_by_window(df).first()
    assert r.vwap is None and r.total_volume == 0


def test_result_rows_version(spark):
    t0 = ms("2024-01-01 00:07:00")
    r = vwap_rows(vwap_by_window(trades_a(spark, [("BTCUSDT", t0, 1, 1, 1)]))).first()
    assert r.version == ms("2024-01-01 00:05:00") // 1000


def test_batch_range_half_open(spark):
    t0 = ms("2024-01-01 00:00:00")
    df = trades_a(spark, [
        ("BTCUSDT", t0, 1, 10, 1), ("BTCUSDT", t0 + 3_599_999, 2, 20, 1),
        ("BTCUSDT", t0 + 3_600_000, 3, 1000, 1)])
    from tidemark.sources.lake import raw_a_projection
    r = batch_vwap_range(raw_a_projection(df), t0, t0 + 3_600_000).collect()
    assert len(r) == 1 and r[0].batch_vwap == 15
    hours = batch_vwap_by_hour(raw_a_projection(df)).orderBy("hour_start_ms").collect()
    assert [h.batch_vwap for h in hours] == [15, 1000]


def test_range_filter_reaches_scan(spark, tmp_dir):
    t0 = ms("2024-01-01 00:00:00")
    from tidemark.sources.lake import raw_a_projection
    raw_a_projection(trades_a(spark, [("BTCUSDT", t0, 1, 10, 1)])).write.parquet(tmp_dir + "/raw")
    plan = batch_vwap_range(spark.read.parquet(tmp_dir + "/raw"), t0, t0 + 1)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(trade_time), GreaterThanOrEqual(trade_time" in plan
    assert "ReadSchema: struct<symbol:string,price:double,quantity:double,trade_time:bigint>" in plan
