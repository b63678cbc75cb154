"""Declared schemas of the feeds, lake tables and keyed result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

DEC = T.DecimalType(18, 8)

TRADES_A = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("event_time", T.LongType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("trade_id", T.LongType()),
    T.StructField("price", DEC),
    T.StructField("quantity", DEC),
    T.StructField("trade_time", T.LongType()),
    T.StructField("is_buyer_maker", T.BooleanType()),
    T.StructField("ingestion_time", T.LongType()),
])

TRADES_B = T.StructType([
    T.StructField("trade_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("price", DEC),
    T.StructField("size", DEC),
    T.StructField("side", T.StringType()),
    T.StructField("event_time", T.LongType()),
    T.StructField("ingestion_time", T.LongType()),
])

RAW_A = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("trade_time", T.LongType()),
    T.StructField("is_buyer_maker", T.BooleanType()),
    T.StructField("ingestion_time", T.LongType()),
])

RAW_B = T.StructType([
    T.StructField("trade_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("size", T.DoubleType()),
    T.StructField("side", T.StringType()),
    T.StructField("event_time", T.LongType()),
    T.StructField("ingestion_time", T.LongType()),
])

DEAD_LETTER = T.StructType([
    T.StructField("original_topic", T.StringType()),
    T.StructField("original_key", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("failed_at", T.LongType()),
])

# Raw message stream: one JSON text per row plus its arrival time.
RAW_MESSAGES = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("received_at", T.LongType()),
])


@dataclass(frozen=True)
class ResultTable:
    """A keyed result table: rows are appended; the highest ``version`` per
    ``key`` (ties: the later ``batch_id``, then the other columns) is the current
    row. ``time`` is the key's time column; its date is a partition."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    time: str
    version: str = "version"


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


S, D, L, TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType()

VWAP_AGGREGATIONS = ResultTable("vwap_aggregations", _s(
    ("symbol", S), ("window_start", TS), ("window_end", TS), ("vwap", D),
    ("total_volume", D), ("trade_count", L), ("interval_label", S), ("version", L)),
    key=("symbol", "window_start", "interval_label"), time="window_start")

WHALE_ALERTS = ResultTable("whale_alerts", _s(
    ("symbol", S), ("price", D), ("quantity", D), ("trade_value", D), ("exchange", S),
    ("side", S), ("event_time", TS), ("version", L)),
    key=("symbol", "event_time"), time="event_time")

ARBITRAGE_SIGNALS = ResultTable("arbitrage_signals", _s(
    ("symbol", S), ("binance_price", D), ("coinbase_price", D), ("spread", D),
    ("spread_pct", D), ("direction", S), ("event_time", TS), ("version", L)),
    key=("symbol", "event_time"), time="event_time")

DOUBLE_BOTTOM_SIGNALS = ResultTable("double_bottom_signals", _s(
    ("symbol", S), ("first_dip", D), ("second_dip", D), ("peak_price", D),
    ("breakout_price", D), ("confirmed_at", TS), ("version", L)),
    key=("symbol", "confirmed_at"), time="confirmed_at")

RECON_RESULTS = ResultTable("recon_results", _s(
    ("run_time", TS), ("window_start", TS), ("window_end", TS), ("symbol", S),
    ("streaming_vwap", D), ("batch_vwap", D), ("diff_pct", D), ("status", S), ("version", L)),
    key=("symbol", "window_start", "run_time"), time="window_start")

RESULT_TABLES = {t.name: t for t in (
    VWAP_AGGREGATIONS, WHALE_ALERTS, ARBITRAGE_SIGNALS, DOUBLE_BOTTOM_SIGNALS, RECON_RESULTS)}
