"""Named queries over the given tables, one per operator.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
derived feeds (see ``sources.testfeeds``). For comparison with the SQL oracle,
times are emitted as epoch-ms ``BIGINT`` and doubles rounded to 6 places.

Events in the given tables are minutes apart, so the time parameters are
widened for them (tumble 1 h, join +-600 s, pattern limit 12 h); the
reference defaults (5 min, +-10 s, 10 min) are covered by unit tests.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import interval_join as J
from tidemark.operators import reads, reconcile, whales
from tidemark.operators.double_bottom import double_bottom, double_bottom_rows
from tidemark.operators.latest import latest_by_key
from tidemark.operators.vwap import batch_vwap_range, vwap_by_window, vwap_rows
from tidemark.sources import testfeeds
from tidemark.sources.lake import raw_a_projection, raw_b_projection

TEST_WINDOW = "1 hour"
TEST_LABEL = "1h"
TEST_HALF_WIDTH_MS = 600_000
TEST_WITHIN_MS = 12 * 3_600_000
MONTH_START = "2024-01-01 00:00:00"
MONTH_END = "2024-02-01 00:00:00"
MONTH_START_MS = 1_704_067_200_000
MONTH_END_MS = 1_706_745_600_000
RUN_TIME = "2024-02-01 00:30:00"


def r6(c) -> Column:
    """Round to 6 places as ``round(x * 1e6) / 1e6`` on the double itself (the
    SQL oracle's rounding), so a value both engines compute identically also
    rounds identically; plain ``round(x, 6)`` rounds the shortest decimal
    text instead and can differ on ties. ``rint`` with ties moved away from zero gives
    what ``round(y, 0)`` does, which goes through a decimal for every value."""
    x = F.col(c) if isinstance(c, str) else c
    y = x * F.lit(1e6)
    whole = F.when(F.abs(y - F.rint(y)) == 0.5, y + F.signum(y) * 0.5).otherwise(F.rint(y) + F.lit(0.0))  # + 0.0: no negative zero
    return whole / F.lit(1e6)


def ms(c) -> Column:
    return F.unix_millis(F.col(c) if isinstance(c, str) else c)


def _feeds(spark: SparkSession, sf_dir: str):
    f = testfeeds.load(spark, sf_dir)
    return f["trades_a"], f["trades_b"]


def q_vwap_by_window(spark, sf_dir) -> DataFrame:
    a, _ = _feeds(spark, sf_dir)
    v = vwap_by_window(a, window=TEST_WINDOW, interval_label=TEST_LABEL)
    return v.select("symbol", ms("window_start").alias("window_start"), ms("window_end").alias("window_end"),
                    r6("vwap").alias("vwap"), r6("total_volume").alias("total_volume"),
                    "trade_count", "interval_label")


def q_vwap_result_rows(spark, sf_dir) -> DataFrame:
    """Reference window (5 min) in result-table form with its version."""
    a, _ = _feeds(spark, sf_dir)
    v = vwap_rows(vwap_by_window(a))
    return v.select("symbol", ms("window_start").alias("window_start"), ms("window_end").alias("window_end"),
                    r6("vwap").alias("vwap"), r6("total_volume").alias("total_volume"),
                    "trade_count", "interval_label", "version")


def q_batch_vwap_range(spark, sf_dir) -> DataFrame:
    a, _ = _feeds(spark, sf_dir)
    return batch_vwap_range(raw_a_projection(a), MONTH_START_MS, MONTH_END_MS).select(
        "symbol", r6("batch_vwap").alias("batch_vwap"))


def _whale_out(df: DataFrame) -> DataFrame:
    return df.select("symbol", r6("price").alias("price"), r6("quantity").alias("quantity"),
                     r6("trade_value").alias("trade_value"), "exchange", "side",
                     ms("event_time").alias("event_time"))


def q_whale_trades(spark, sf_dir) -> DataFrame:
    a, b = _feeds(spark, sf_dir)
    return _whale_out(whales.whale_trades(a, b))


def q_whale_trades_normalised(spark, sf_dir) -> DataFrame:
    a, b = _feeds(spark, sf_dir)
    return _whale_out(whales.whale_trades(a, b, normalise=True))


def q_whale_flags(spark, sf_dir) -> DataFrame:
    a, b = _feeds(spark, sf_dir)
    f = whales.whale_flags(a, b)
    return f.select("symbol", "trade_id", "exchange", r6("price").alias("price"),
                    r6("quantity").alias("quantity"), "side", "event_time", "is_whale",
                    "base_asset", r6("trade_value").alias("trade_value"))


def q_interval_join_pairs(spark, sf_dir) -> DataFrame:
    a, b = _feeds(spark, sf_dir)
    p = J.interval_join(a, b, half_width_ms=TEST_HALF_WIDTH_MS)
    return p.select("symbol", r6("a_price").alias("a_price"), r6("b_price").alias("b_price"),
                    "a_time_ms", "b_time_ms")


def q_arbitrage_signals(spark, sf_dir) -> DataFrame:
    a, b = _feeds(spark, sf_dir)
    s = J.arbitrage_signals(a, b, half_width_ms=TEST_HALF_WIDTH_MS)
    return s.select("symbol", r6("binance_price").alias("binance_price"),
                    r6("coinbase_price").alias("coinbase_price"), r6("spread").alias("spread"),
                    r6("spread_pct").alias("spread_pct"), "direction",
                    F.col("event_time_ms").alias("event_time"))


def q_arbitrage_signals_default(spark, sf_dir) -> DataFrame:
    """The reference configuration: +-10 s, spread above 0.2 %."""
    a, b = _feeds(spark, sf_dir)
    s = J.arbitrage_signals(a, b)
    return s.select("symbol", r6("binance_price").alias("binance_price"),
                    r6("coinbase_price").alias("coinbase_price"), r6("spread").alias("spread"),
                    r6("spread_pct").alias("spread_pct"), "direction",
                    F.col("event_time_ms").alias("event_time"))


def _alert_rows(spark, sf_dir) -> DataFrame:
    a, b = _feeds(spark, sf_dir)
    return whales.whale_alert_rows(whales.whale_trades(a, b, normalise=True))


def q_latest_by_key(spark, sf_dir) -> DataFrame:
    rows = _alert_rows(spark, sf_dir)
    latest = latest_by_key(rows, ["symbol", "event_time"])
    return latest.select("symbol", r6("price").alias("price"), r6("quantity").alias("quantity"),
                         r6("trade_value").alias("trade_value"), "exchange", "side",
                         ms("event_time").alias("event_time"), "version")


def q_top_recent_alerts(spark, sf_dir) -> DataFrame:
    a, b = _feeds(spark, sf_dir)
    alerts = whales.whale_trades(a, b, normalise=True)
    t = reads.top_recent_alerts(alerts, MONTH_START, MONTH_END, n=100)
    return _whale_out(t)


def q_vwap_series(spark, sf_dir) -> DataFrame:
    a, _ = _feeds(spark, sf_dir)
    v = vwap_by_window(a, window=TEST_WINDOW, interval_label=TEST_LABEL)
    s = reads.vwap_series(v, MONTH_START, MONTH_END)
    return s.select(ms("time").alias("time"), "metric", r6("vwap").alias("vwap"))


def _recon_sides(spark, sf_dir):
    """The lake rows of venue A and the 5-minute windows over the same trades, both whole."""
    a, _ = _feeds(spark, sf_dir)
    return raw_a_projection(a), vwap_rows(vwap_by_window(a))


def _with_outages(lake, streamed):
    """Stand-in input of ``reconcile_missing``: the streamed side lacks every 7th hour and, in
    every 5th, symbols after 'BTCUSDT'; the lake lacks every 11th hour and, in
    every 13th, 'BTCUSDT'; in every 17th hour its trades have price 0."""
    hour = F.floor(F.unix_millis("window_start") / 3_600_000)
    streamed = streamed.where((hour % 7 != 0) & ((hour % 5 != 0) | (F.col("symbol") <= "BTCUSDT")))
    lake_hour = F.floor(F.col("trade_time") / 3_600_000)
    lake = (lake.where((lake_hour % 11 != 0) & ((lake_hour % 13 != 0) | (F.col("symbol") != "BTCUSDT")))
            .withColumn("price", F.when(lake_hour % 17 == 0, F.lit(0.0)).otherwise(F.col("price"))))
    return lake, streamed


def q_reconcile(spark, sf_dir) -> DataFrame:
    res, _ = reconcile.reconcile_hourly(*_recon_sides(spark, sf_dir), run_time=RUN_TIME)
    return res.select(ms("run_time").alias("run_time"), ms("window_start").alias("window_start"),
                      ms("window_end").alias("window_end"), "symbol",
                      r6("streaming_vwap").alias("streaming_vwap"), r6("batch_vwap").alias("batch_vwap"),
                      r6("diff_pct").alias("diff_pct"), "status", "version")


def q_reconcile_missing(spark, sf_dir) -> DataFrame:
    _, miss = reconcile.reconcile_hourly(*_with_outages(*_recon_sides(spark, sf_dir)), run_time=RUN_TIME)
    return miss.select(ms("window_start").alias("window_start"), "symbol",
                       r6("streaming_vwap").alias("streaming_vwap"), r6("batch_vwap").alias("batch_vwap"),
                       "reason")


def _recon_streamed(spark, sf_dir):
    """The lake (all trades) against the VWAP windows the streaming job wrote
    (5-minute windows; those still open at the final watermark are absent)."""
    from tidemark.plans import stream_runs
    a, _ = _feeds(spark, sf_dir)
    streamed = stream_runs.run_vwap(spark, sf_dir, window="5 minutes", label="5m")
    return reconcile.reconcile_hourly(raw_a_projection(a), streamed, run_time=RUN_TIME)


def q_reconcile_streamed(spark, sf_dir) -> DataFrame:
    res, _ = _recon_streamed(spark, sf_dir)
    return res.select(ms("run_time").alias("run_time"), ms("window_start").alias("window_start"),
                      ms("window_end").alias("window_end"), "symbol",
                      r6("streaming_vwap").alias("streaming_vwap"), r6("batch_vwap").alias("batch_vwap"),
                      r6("diff_pct").alias("diff_pct"), "status", "version")


def q_reconcile_streamed_missing(spark, sf_dir) -> DataFrame:
    _, miss = _recon_streamed(spark, sf_dir)
    return miss.select(ms("window_start").alias("window_start"), "symbol",
                       r6("streaming_vwap").alias("streaming_vwap"), r6("batch_vwap").alias("batch_vwap"),
                       "reason")


def q_normalise_symbols(spark, sf_dir) -> DataFrame:
    _, b = _feeds(spark, sf_dir)
    from tidemark.functions.columns import normalise_symbol
    return b.select("trade_id", "product_id", normalise_symbol("product_id").alias("symbol"))


def q_raw_a_projection(spark, sf_dir) -> DataFrame:
    a, _ = _feeds(spark, sf_dir)
    r = raw_a_projection(a)
    return r.select("symbol", r6("price").alias("price"), r6("quantity").alias("quantity"),
                    "trade_time", "is_buyer_maker", "ingestion_time")


def q_raw_b_projection(spark, sf_dir) -> DataFrame:
    _, b = _feeds(spark, sf_dir)
    r = raw_b_projection(b)
    return r.select("trade_id", "product_id", r6("price").alias("price"), r6("size").alias("size"),
                    "side", "event_time", "ingestion_time")


def _db_out(m: DataFrame) -> DataFrame:
    return m.select("symbol", r6("first_dip").alias("first_dip"), r6("second_dip").alias("second_dip"),
                    r6("peak_price").alias("peak_price"), r6("breakout_price").alias("breakout_price"),
                    F.col("confirmed_at_ms").alias("confirmed_at"))


def q_double_bottom(spark, sf_dir) -> DataFrame:
    a, _ = _feeds(spark, sf_dir)
    return _db_out(double_bottom(a, within_ms=TEST_WITHIN_MS))


def q_double_bottom_default(spark, sf_dir) -> DataFrame:
    """The reference configuration: 10-minute limit."""
    a, _ = _feeds(spark, sf_dir)
    return _db_out(double_bottom(a))


def q_double_bottom_next_row(spark, sf_dir) -> DataFrame:
    a, _ = _feeds(spark, sf_dir)
    return _db_out(double_bottom(a, within_ms=TEST_WITHIN_MS, after_match="next_row"))


def q_double_bottom_latest(spark, sf_dir) -> DataFrame:
    """``next_row`` matches as result rows, read through the latest-by-key view
    (matches sharing symbol and confirmation second collapse)."""
    a, _ = _feeds(spark, sf_dir)
    rows = double_bottom_rows(double_bottom(a, within_ms=TEST_WITHIN_MS, after_match="next_row"))
    latest = latest_by_key(rows, ["symbol", "confirmed_at"])
    return latest.select("symbol", r6("first_dip").alias("first_dip"), r6("second_dip").alias("second_dip"),
                         r6("peak_price").alias("peak_price"), r6("breakout_price").alias("breakout_price"),
                         ms("confirmed_at").alias("confirmed_at"), "version")


def _parsed(spark, sf_dir):
    from tidemark.operators import ingest
    ev = testfeeds.load(spark, sf_dir)["events"]
    ta, da = ingest.parse_feed_a(testfeeds.raw_feed_a(ev))
    tb, db = ingest.parse_feed_b(testfeeds.raw_feed_b(ev))
    return ta, da, tb, db


def q_parse_feed_a(spark, sf_dir) -> DataFrame:
    ta, _, _, _ = _parsed(spark, sf_dir)
    return ta.select("event_type", "event_time", "symbol", "trade_id", r6(F.col("price").cast("double")).alias("price"),
                     r6(F.col("quantity").cast("double")).alias("quantity"), "trade_time", "is_buyer_maker",
                     "ingestion_time")


def q_parse_feed_b(spark, sf_dir) -> DataFrame:
    _, _, tb, _ = _parsed(spark, sf_dir)
    return tb.select("trade_id", "product_id", r6(F.col("price").cast("double")).alias("price"),
                     r6(F.col("size").cast("double")).alias("size"), "side", "event_time", "ingestion_time")


def q_dead_letter_rows(spark, sf_dir) -> DataFrame:
    _, da, _, db = _parsed(spark, sf_dir)
    return da.unionByName(db)


def q_latency_stats(spark, sf_dir) -> DataFrame:
    from tidemark.operators import ingest
    ta, _, tb, _ = _parsed(spark, sf_dir)
    return ingest.latency_stats(ta, tb).select(
        "symbol", "exchange", "trades", "min_latency_ms", "max_latency_ms",
        r6("avg_latency_ms").alias("avg_latency_ms"))


def q_stream_vwap(spark, sf_dir) -> DataFrame:
    from tidemark.plans import stream_runs
    v = stream_runs.run_vwap(spark, sf_dir, window=TEST_WINDOW, label=TEST_LABEL)
    return v.select("symbol", ms("window_start").alias("window_start"), ms("window_end").alias("window_end"),
                    r6("vwap").alias("vwap"), r6("total_volume").alias("total_volume"),
                    "trade_count", "interval_label", "version")


def q_stream_whales(spark, sf_dir) -> DataFrame:
    from tidemark.plans import stream_runs
    w = stream_runs.run_whales(spark, sf_dir)
    return _whale_out(w).withColumn("version", F.unix_seconds(F.timestamp_millis("event_time")))


def q_stream_arbitrage(spark, sf_dir) -> DataFrame:
    from tidemark.plans import stream_runs
    a = stream_runs.run_arbitrage(spark, sf_dir, half_width_ms=TEST_HALF_WIDTH_MS)
    return a.select("symbol", r6("binance_price").alias("binance_price"),
                    r6("coinbase_price").alias("coinbase_price"), r6("spread").alias("spread"),
                    r6("spread_pct").alias("spread_pct"), "direction", ms("event_time").alias("event_time"),
                    "version")


def q_stream_double_bottom(spark, sf_dir) -> DataFrame:
    from tidemark.plans import stream_runs
    d = stream_runs.run_double_bottom(spark, sf_dir, within_ms=TEST_WITHIN_MS)
    return d.select("symbol", r6("first_dip").alias("first_dip"), r6("second_dip").alias("second_dip"),
                    r6("peak_price").alias("peak_price"), r6("breakout_price").alias("breakout_price"),
                    ms("confirmed_at").alias("confirmed_at"), "version")


def q_stream_double_bottom_next_row(spark, sf_dir) -> DataFrame:
    from tidemark.plans import stream_runs
    d = stream_runs.run_double_bottom(spark, sf_dir, within_ms=TEST_WITHIN_MS, after_match="next_row")
    return d.select("symbol", r6("first_dip").alias("first_dip"), r6("second_dip").alias("second_dip"),
                    r6("peak_price").alias("peak_price"), r6("breakout_price").alias("breakout_price"),
                    ms("confirmed_at").alias("confirmed_at"), "version")


def q_stream_lake_a(spark, sf_dir) -> DataFrame:
    from tidemark.plans import stream_runs
    la, _ = stream_runs.run_lake(spark, sf_dir)
    return la.select("symbol", r6("price").alias("price"), r6("quantity").alias("quantity"),
                     "trade_time", "is_buyer_maker", "ingestion_time")


def q_stream_lake_b(spark, sf_dir) -> DataFrame:
    from tidemark.plans import stream_runs
    _, lb = stream_runs.run_lake(spark, sf_dir)
    return lb.select("trade_id", "product_id", r6("price").alias("price"), r6("size").alias("size"),
                     "side", "event_time", "ingestion_time")


def q_stream_ingest_a(spark, sf_dir) -> DataFrame:
    from tidemark.plans import stream_runs
    t, _ = stream_runs.run_ingest(spark, sf_dir, "a")
    return t.select("event_type", "event_time", "symbol", "trade_id", r6(F.col("price").cast("double")).alias("price"),
                    r6(F.col("quantity").cast("double")).alias("quantity"), "trade_time", "is_buyer_maker",
                    "ingestion_time")


def q_stream_dead_letter_b(spark, sf_dir) -> DataFrame:
    from tidemark.plans import stream_runs
    _, d = stream_runs.run_ingest(spark, sf_dir, "b")
    return d


RUN_TIMES = (datetime(2024, 1, 31, 23, 30), datetime(2024, 2, 1, 0, 30))


def q_stream_arbitrage_idle(spark, sf_dir) -> DataFrame:
    """The join job with heartbeats for a silent venue (idle after a day of event time)."""
    from tidemark.plans import stream_runs
    a = stream_runs.run_arbitrage(spark, sf_dir, half_width_ms=TEST_HALF_WIDTH_MS, idle_ms=86_400_000)
    return a.select("symbol", r6("binance_price").alias("binance_price"),
                    r6("coinbase_price").alias("coinbase_price"), r6("spread").alias("spread"),
                    r6("spread_pct").alias("spread_pct"), "direction", ms("event_time").alias("event_time"),
                    "version")


def _catalog(spark, sf_dir):
    from tidemark.plans import stream_runs
    return stream_runs.run_catalog(spark, sf_dir, MONTH_START_MS, MONTH_END_MS, datetime.fromisoformat(MONTH_START), datetime.fromisoformat(MONTH_END))


def q_catalog_raw_a_range(spark, sf_dir) -> DataFrame:
    """Raw trades of venue A as the lake job wrote them, read from the catalog table."""
    r, _, _ = _catalog(spark, sf_dir)
    return r.select("symbol", r6("price").alias("price"), r6("quantity").alias("quantity"),
                    "trade_time", "is_buyer_maker", "ingestion_time")


def q_catalog_result_range(spark, sf_dir) -> DataFrame:
    """Current VWAP windows as the streaming job wrote them, read from the catalog table."""
    _, _, v = _catalog(spark, sf_dir)
    return _vwap_out(v)


def _vwap_out(v: DataFrame) -> DataFrame:
    return v.select("symbol", ms("window_start").alias("window_start"), ms("window_end").alias("window_end"),
                    r6("vwap").alias("vwap"), r6("total_volume").alias("total_volume"),
                    "trade_count", "interval_label", "version")


def q_compacted_rows(spark, sf_dir) -> DataFrame:
    from tidemark.plans import stream_runs
    return _vwap_out(stream_runs.run_compacted(spark, sf_dir, first_before="2024-01-11", then_before="2024-01-21"))


def q_reconcile_run(spark, sf_dir) -> DataFrame:
    """Current verdicts after two incremental runs over the stored lake and windows."""
    from tidemark.plans import stream_runs
    v = stream_runs.run_reconciliation(spark, sf_dir, run_times=RUN_TIMES, first_lake_batch=4)
    return v.select(ms("window_start").alias("window_start"), ms("window_end").alias("window_end"), "symbol",
                    r6("streaming_vwap").alias("streaming_vwap"), r6("batch_vwap").alias("batch_vwap"),
                    r6("diff_pct").alias("diff_pct"), "status")


def q_stream_latest(spark, sf_dir) -> DataFrame:
    from tidemark.plans import stream_runs
    latest = stream_runs.run_latest_alerts(spark, sf_dir)
    return latest.select("symbol", r6("price").alias("price"), r6("quantity").alias("quantity"),
                         r6("trade_value").alias("trade_value"), "exchange", "side",
                         ms("event_time").alias("event_time"), "version")


def q_stored_recent_alerts(spark, sf_dir) -> DataFrame:
    """The newest 100 alerts of the stored table, opening only the newest dates."""
    from tidemark.plans import stream_runs
    return _whale_out(stream_runs.run_recent_alerts(spark, sf_dir, MONTH_START, MONTH_END, 100))


def q_latency_quantiles(spark, sf_dir) -> DataFrame:
    """Median and tail latencies per symbol and venue from hourly sketches."""
    from tidemark.operators import ingest
    ta, _, tb, _ = _parsed(spark, sf_dir)
    return ingest.latency_quantiles(ingest.latency_sketches(ta, tb))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_vwap": q_stream_vwap,
    "stream_whales": q_stream_whales,
    "stream_arbitrage": q_stream_arbitrage,
    "stream_arbitrage_idle": q_stream_arbitrage_idle,
    "stream_latest": q_stream_latest,
    "catalog_raw_a_range": q_catalog_raw_a_range,
    "catalog_result_range": q_catalog_result_range,
    "compacted_rows": q_compacted_rows,
    "reconcile_run": q_reconcile_run,
    "stored_recent_alerts": q_stored_recent_alerts,
    "latency_quantiles": q_latency_quantiles,
    "stream_double_bottom": q_stream_double_bottom,
    "stream_double_bottom_next_row": q_stream_double_bottom_next_row,
    "stream_lake_a": q_stream_lake_a,
    "stream_lake_b": q_stream_lake_b,
    "stream_ingest_a": q_stream_ingest_a,
    "stream_dead_letter_b": q_stream_dead_letter_b,
    "parse_feed_a": q_parse_feed_a,
    "parse_feed_b": q_parse_feed_b,
    "dead_letter_rows": q_dead_letter_rows,
    "latency_stats": q_latency_stats,
    "double_bottom": q_double_bottom,
    "double_bottom_next_row": q_double_bottom_next_row,
    "double_bottom_default": q_double_bottom_default,
    "double_bottom_latest": q_double_bottom_latest,
    "vwap_by_window": q_vwap_by_window,
    "vwap_result_rows": q_vwap_result_rows,
    "batch_vwap_range": q_batch_vwap_range,
    "whale_trades": q_whale_trades,
    "whale_trades_normalised": q_whale_trades_normalised,
    "whale_flags": q_whale_flags,
    "interval_join_pairs": q_interval_join_pairs,
    "arbitrage_signals": q_arbitrage_signals,
    "arbitrage_signals_default": q_arbitrage_signals_default,
    "latest_by_key": q_latest_by_key,
    "top_recent_alerts": q_top_recent_alerts,
    "vwap_series": q_vwap_series,
    "reconcile": q_reconcile,
    "reconcile_missing": q_reconcile_missing,
    "reconcile_streamed": q_reconcile_streamed,
    "reconcile_streamed_missing": q_reconcile_streamed_missing,
    "normalise_symbols": q_normalise_symbols,
    "raw_a_projection": q_raw_a_projection,
    "raw_b_projection": q_raw_b_projection,
}
