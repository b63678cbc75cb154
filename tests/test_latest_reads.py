from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators.latest import latest_by_key
from tidemark.operators.reads import top_recent_alerts, vwap_series


def test_latest_by_version_then_batch_then_seq(spark):
    rows = [("BTC", 1, 10, 0, 0, 1.0), ("BTC", 1, 11, 0, 0, 2.0),          # higher version wins
            ("ETH", 1, 10, 0, 0, 3.0), ("ETH", 1, 10, 1, 0, 4.0),          # equal versions: later batch
            ("SOL", 1, 10, 2, 5, 5.0), ("SOL", 1, 10, 2, 7, 6.0),          # same batch: later row
            ("SOL", 2, 10, 0, 0, 7.0)]
    df = spark.createDataFrame(rows, "symbol string, t long, version long, batch_id long, seq long, v double")
    got = {(r.symbol, r.t): r.v for r in latest_by_key(df, ["symbol", "t"]).collect()}
    assert got == {("BTC", 1): 2.0, ("ETH", 1): 4.0, ("SOL", 1): 6.0, ("SOL", 2): 7.0}


def _alerts(spark, times):
    rows = [(datetime.fromisoformat(t), s, 1.0, 1.0, 1.0, "binance", "BUY") for t, s in times]
    return spark.createDataFrame(rows, "event_time timestamp, symbol string, price double, quantity double, "
                                       "trade_value double, exchange string, side string")


def test_top_recent_range_inclusive_and_ties(spark):
    df = _alerts(spark, [("2024-01-01 00:00:00", "A"), ("2024-01-01 00:00:10", "B"),
                         ("2024-01-01 00:00:10", "C"), ("2024-01-01 00:00:20", "D"),
                         ("2024-01-01 00:00:21", "E")])
    out = top_recent_alerts(df, "2024-01-01 00:00:00", "2024-01-01 00:00:20", n=3).collect()
    assert [r.symbol for r in out] == ["D", "C", "B"]
    out = top_recent_alerts(df, "2024-01-01 00:00:00", "2024-01-01 00:00:20").collect()
    assert [r.symbol for r in out] == ["D", "C", "B", "A"]           # fewer than 100 rows


def test_top_recent_is_not_a_full_sort(spark):
    df = _alerts(spark, [("2024-01-01 00:00:00", "A")])
    plan = top_recent_alerts(df, "2024-01-01", "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_vwap_series(spark):
    rows = [(datetime(2024, 1, 1, 0, 5), "BTCUSDT", 10.0), (datetime(2024, 1, 1, 0, 0), "ETHUSDT", 20.0),
            (datetime(2024, 1, 1, 1, 0), "BTCUSDT", 30.0)]
    df = spark.createDataFrame(rows, "window_start timestamp, symbol string, vwap double")
    out = vwap_series(df, "2024-01-01 00:00:00", "2024-01-01 00:05:00").collect()
    assert [(r.metric, r.vwap) for r in out] == [("ETHUSDT VWAP", 20.0), ("BTCUSDT VWAP", 10.0)]
