from datetime import datetime, timezone

from pyspark.sql import functions as F

from tidemark.functions.columns import direction, normalise_symbol, side_from_maker, spread_pct
from tidemark.operators.latest import latest_by_key
from tidemark.operators.whales import whale_alert_rows


def test_normalise_is_substring_replacement(spark):
    df = spark.createDataFrame([("BTC-USD",), ("BTC-USDC",), ("BTCUSDT",)], "p string")
    got = [r.s for r in df.select(normalise_symbol("p").alias("s")).collect()]
    assert got == ["BTCUSDT", "BTCUSDTC", "BTCUSDT"]


def test_side_direction_and_spread(spark):
    df = spark.createDataFrame([(True, 100.0, 99.0), (None, 100.0, 101.0), (False, 0.0, 1.0)],
                               "m boolean, pa double, pb double")
    got = df.select(side_from_maker("m").alias("side"), direction("pa", "pb").alias("d"),
                    spread_pct("pa", "pb").alias("pct")).collect()
    assert [r.side for r in got] == ["SELL", "BUY", "BUY"]
    assert [r.d for r in got] == ["BUY_COINBASE_SELL_BINANCE", "BUY_BINANCE_SELL_COINBASE",
                                  "BUY_BINANCE_SELL_COINBASE"]
    assert got[2].pct is None                      # zero price: no ANSI error, null


def test_two_alerts_in_one_second_collapse(spark):
    rows = [("BTCUSDT", 100.0, 6.0, 600.0, "binance", "BUY", datetime(2024, 1, 1, 0, 0, 5, 100000)),
            ("BTCUSDT", 101.0, 7.0, 707.0, "coinbase", "SELL", datetime(2024, 1, 1, 0, 0, 5, 900000))]
    df = spark.createDataFrame(rows, "symbol string, price double, quantity double, trade_value double, "
                                     "exchange string, side string, event_time timestamp")
    alerts = whale_alert_rows(df)
    assert alerts.select("event_time").distinct().count() == 1
    assert alerts.count() == 2                      # the appended table keeps both
    cur = latest_by_key(alerts, ["symbol", "event_time"]).collect()
    assert len(cur) == 1 and cur[0].version == int(datetime(2024, 1, 1, 0, 0, 5, tzinfo=timezone.utc).timestamp())
