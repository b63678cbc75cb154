import re

import pytest
from conftest import ms
from rows import trades_a, trades_b

from tidemark.operators.whales import _preimages, whale_flags, whale_trades


def _a(spark):
    t = ms("2024-01-01 00:00:00")
    return trades_a(spark, [
        ("BTCUSDT", t, 1, 100, 5, True), ("BTCUSDT", t, 2, 100, "4.99999999"),
        ("ETHUSDT", t, 3, 10, 50), ("ETHUSDT", t, 4, 10, "49.9"),
        ("SOLUSDT", t, 5, 1, 500), ("SOLUSDT", t, 6, 1, 499),
        ("DOGEUSDT", t, 7, 1, 10_000_000)])


def _b(spark):
    t = ms("2024-01-01 00:00:01")
    return trades_b(spark, [("BTC-USD", t, 10, 100, 6, "SELL"), ("ETH-USD", t, 11, 10, 1)])


def test_thresholds_inclusive_unknown_dropped(spark):
    rows = whale_trades(_a(spark), _b(spark)).collect()
    got = sorted((r.symbol, r.quantity, r.exchange, r.side) for r in rows)
    assert got == [("BTCUSDT", 5.0, "binance", "SELL"), ("ETHUSDT", 50.0, "binance", "BUY"),
                   ("SOLUSDT", 500.0, "binance", "BUY")]


def test_venue_b_needs_normalisation(spark):
    rows = whale_trades(_a(spark), _b(spark), normalise=True).collect()
    b = [r for r in rows if r.exchange == "coinbase"]
    assert [(r.symbol, r.quantity, r.side, r.trade_value) for r in b] == [("BTCUSDT", 6.0, "SELL", 600.0)]


def test_flags_use_unknown_threshold(spark):
    f = {(r.exchange, r.trade_id): r for r in whale_flags(_a(spark), _b(spark)).collect()}
    assert f[("binance", "7")].is_whale is True          # 10M >= 999999
    assert f[("binance", "2")].is_whale is False
    assert f[("coinbase", "10")].is_whale is True and f[("coinbase", "10")].symbol == "BTCUSDT"
    assert f[("binance", "1")].base_asset == "BTC"


@pytest.mark.parametrize("n", [3, 64, 65, 500])
@pytest.mark.parametrize("normalise", [False, True])
def test_threshold_filter_pushed_to_scan(spark, tmp_dir, n, normalise):
    _a(spark).write.parquet(tmp_dir + "/a")
    _b(spark).write.parquet(tmp_dir + "/b")
    thresholds = {"BTCUSDT": 5.0, "ETHUSDT": 50.0, "SOLUSDT": 500.0, **{f"X{i}USDT": 7.5 for i in range(n - 3)}}
    df = whale_trades(spark.read.parquet(tmp_dir + "/a"), spark.read.parquet(tmp_dir + "/b"), thresholds=thresholds, normalise=normalise)
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = re.findall(r"PushedFilters: \[(.*)", plan)
    assert len(pushed) == 2
    assert "In(symbol, [" in pushed[0] and "GreaterThanOrEqual(quantity,5.00000000)" in pushed[0]
    assert "In(product_id, [" in pushed[1] and "GreaterThanOrEqual(size,5.00000000)" in pushed[1]
    assert "Exchange" not in plan
    few = whale_trades(_a(spark), _b(spark), normalise=normalise).collect()
    assert sorted(df.collect()) == sorted(few)


def test_preimages():
    assert _preimages("BTCUSDT") == ["BTC-USD", "BTCUSDT"]
    assert _preimages("USDTUSDT") == ["-USD-USD", "-USDUSDT", "USDT-USD", "USDTUSDT"]
    assert _preimages("BTC") == ["BTC"]
