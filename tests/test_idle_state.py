"""A silent venue, and what stateful jobs keep in their checkpoints."""

import os

import pytest
from conftest import ms
from rows import trades_a, trades_b

from tidemark.operators.interval_join import arbitrage_signals
from tidemark.sources import feeds
from tidemark.streaming import jobs, state_audit

ONCE = {"availableNow": True}
T0 = ms("2024-01-01 00:00:00")


def _append(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def _run(spark, d, name="x", **kw):
    q = jobs.arbitrage_job(feeds.read_trades_a(spark, d + "/a", stream=True, max_files_per_trigger=1),
                           feeds.read_trades_b(spark, d + "/b", stream=True, max_files_per_trigger=1), f"{d}/out-{name}",
                           checkpoint=f"{d}/ck-{name}", trigger=ONCE, **kw)
    q.awaitTermination()
    return q


def _signals(spark, d, name="x"):
    return sorted((r.symbol, r.binance_price, r.coinbase_price) for r in spark.read.parquet(f"{d}/out-{name}").collect())


def _rows_kept(spark, d, name, side):
    return state_audit.join_state(spark, f"{d}/ck-{name}", side).count()


def _a(k, n=10):  # batch k of venue A: one trade a second, a minute per batch
    return [("BTCUSDT", T0 + k * 60_000 + i * 6_000, 100 * k + i, 100 + i, 1) for i in range(n)]


def test_a_silent_venue_holds_nothing_back(spark, tmp_dir):
    _append(trades_b(spark, [("BTC-USD", T0 + 1000, 1, 90, 1)]), tmp_dir + "/b")
    for k in range(6):
        _append(trades_a(spark, _a(k)), tmp_dir + "/a")
    _run(spark, tmp_dir, "plain")
    _run(spark, tmp_dir, "idle", idle_ms=30_000)
    assert _signals(spark, tmp_dir, "plain") == _signals(spark, tmp_dir, "idle") != []
    # without heartbeats the silent venue keeps every row of the other in the state
    assert state_audit.watermark_ms(spark, tmp_dir + "/ck-plain") <= T0 + 1000
    wm = state_audit.watermark_ms(spark, tmp_dir + "/ck-idle")
    newest = T0 + 5 * 60_000 + 54_000
    assert T0 + 4 * 60_000 < wm <= newest - 30_000 - 10_000
    assert _rows_kept(spark, tmp_dir, "idle", "left") < _rows_kept(spark, tmp_dir, "plain", "left")
    assert state_audit.join_state(spark, tmp_dir + "/ck-idle", "right").count() == 0  # no heartbeat is kept
    assert state_audit.expired_join_rows(spark, tmp_dir + "/ck-idle", 10_000).count() == 0
    # late rows of the silent venue within the delay still join, after a restart that keeps the state; older ones do not
    late, older = newest - 35_000, wm - 60_000
    _append(trades_b(spark, [("BTC-USD", late, 2, 50, 1), ("BTC-USD", older, 3, 40, 1)]), tmp_dir + "/b")
    before = len(_signals(spark, tmp_dir, "idle"))
    _run(spark, tmp_dir, "idle", idle_ms=30_000)
    new = [s for s in _signals(spark, tmp_dir, "idle") if s[2] in (50.0, 40.0)]
    rows = [r for k in range(6) for r in _a(k)]
    want = arbitrage_signals(trades_a(spark, rows), trades_b(spark, [("BTC-USD", late, 2, 50, 1)])).collect()
    assert new == sorted((r.symbol, r.binance_price, r.coinbase_price) for r in want) and len(new) >= 3
    assert len(_signals(spark, tmp_dir, "idle")) == before + len(new)


def test_both_venues_active_gives_the_batch_result(spark, tmp_dir):
    a_rows = [r for k in range(4) for r in _a(k)]
    b_rows = [("BTC-USD", T0 + i * 5000 + 500, i, 95 + i % 9, 1) for i in range(48)]
    for k in range(4):
        _append(trades_a(spark, _a(k)), tmp_dir + "/a")
        _append(trades_b(spark, [r for r in b_rows if k * 60_000 <= r[1] - T0 < (k + 1) * 60_000]), tmp_dir + "/b")
    _run(spark, tmp_dir, idle_ms=5_000)
    want = arbitrage_signals(trades_a(spark, a_rows), trades_b(spark, b_rows)).collect()
    assert _signals(spark, tmp_dir) == sorted((r.symbol, r.binance_price, r.coinbase_price) for r in want) != []
    assert state_audit.expired_join_rows(spark, tmp_dir + "/ck-x", 10_000).count() == 0
    assert _rows_kept(spark, tmp_dir, "x", "left") < len(a_rows)


@pytest.mark.parametrize("batches", [1, 8])
def test_window_state_ends_with_the_watermark(spark, tmp_dir, batches):
    for k in range(batches):
        _append(trades_a(spark, [(s, T0 + k * 400_000 + i * 20_000, i, 100, 1) for i in range(20) for s in ("BTCUSDT", "ETHUSDT")]), tmp_dir + "/a")
    ck = tmp_dir + "/ck"
    jobs.vwap_job(feeds.read_trades_a(spark, tmp_dir + "/a", stream=True, max_files_per_trigger=1), tmp_dir + "/out", checkpoint=ck,
                  trigger=ONCE).awaitTermination()
    wm, newest = state_audit.watermark_ms(spark, ck), T0 + (batches - 1) * 400_000 + 380_000
    assert wm == newest - 10_000
    assert state_audit.expired_windows(spark, ck).count() == 0
    open_ = state_audit.window_state(spark, ck).collect()
    assert {r.symbol for r in open_} == {"BTCUSDT", "ETHUSDT"} and len(open_) == 2 * len({r.window_start for r in open_})
    assert len({r.window_start for r in open_}) <= 2
    names = {r.operatorName for r in state_audit.operators(spark, ck).collect()}
    assert names == {"stateStoreSave"}


def test_late_rows_are_counted_per_batch(spark, tmp_dir):
    """Rows of closed windows by batch; rows that are late but whose window is open are not among them."""
    src, ck = tmp_dir + "/a", tmp_dir + "/ck"
    batches = [[("BTCUSDT", T0 + 1_000, 1, 100, 1), ("BTCUSDT", T0 + 320_000, 2, 200, 1)],
               [("BTCUSDT", T0 + 2_000, 3, 1, 1), ("BTCUSDT", T0 + 3_000, 4, 1, 1), ("ETHUSDT", T0 + 299_999, 5, 1, 1), ("BTCUSDT", T0 + 305_000, 6, 5, 1),
                ("BTCUSDT", T0 + 900_000, 7, 5, 1)],
               [("BTCUSDT", T0 + 310_000, 8, 5, 1), ("BTCUSDT", T0 + 890_000, 9, 5, 1), ("BTCUSDT", T0 + 910_000, 10, 5, 1)]]
    for rows in batches:
        _append(trades_a(spark, rows), src)
        jobs.vwap_job(feeds.read_trades_a(spark, src, stream=True), tmp_dir + "/out", checkpoint=ck, trigger=ONCE).awaitTermination()
    trades = feeds.read_trades_a(spark, src)
    late = state_audit.late_rows(spark, ck, trades).collect()
    by_input = {}
    for r in late:
        by_input.setdefault(r.batch, []).append((r.symbol, ms(str(r.window_start)) - T0, r["rows"]))
    assert [sorted(by_input[b]) for b in sorted(by_input)] == [[("BTCUSDT", 0, 2), ("ETHUSDT", 0, 1)], [("BTCUSDT", 300_000, 1)]]
    # every row is in a written window, late, or in a window that is still open
    written = sum(r.trade_count for r in spark.read.parquet(tmp_dir + "/out").collect())
    open_from = min(ms(str(r.window_start)) for r in state_audit.window_state(spark, ck).collect())
    still_open = sum(t >= open_from for rows in batches for _, t, *_ in rows)
    assert written + sum(r["rows"] for r in late) + still_open == sum(map(len, batches))
    for _ in range(2):
        state_audit.record_late_rows(spark, ck, trades, tmp_dir + "/late")
    assert spark.read.parquet(tmp_dir + "/late").agg({"rows": "sum"}).first()[0] == sum(r["rows"] for r in late)
