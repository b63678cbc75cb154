"""Volume-weighted average price over event-time tumbling windows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.functions.columns import as_double, half_open, ms_to_ts, safe_div, version_of


def vwap_by_window(trades: DataFrame, *, window: str = C.VWAP_WINDOW,
                   interval_label: str = C.VWAP_INTERVAL_LABEL,
                   time_col: str = "trade_time", price_col: str = "price",
                   qty_col: str = "quantity", id_col: str = "trade_id",
                   symbol_col: str = "symbol", watermark: str | None = None) -> DataFrame:
    """Per symbol and ``[start, end)`` window: ``vwap = sum(p*q) / sum(q)``,
    ``total_volume = sum(q)``, ``trade_count = count(id)`` (non-null ids).

    A row exactly on a window edge belongs to the later window. Zero volume
    gives a null vwap. With ``watermark`` set (streaming), a window is emitted
    once, when the watermark passes its end; later rows for it are dropped.

    The aggregation is partial per input partition (map-side combine), so a
    hot symbol only ships one partial row per window and partition."""
    df = trades.select(
        F.col(symbol_col).alias("symbol"),
        ms_to_ts(time_col).alias("event_ts"),
        as_double(price_col).alias("p"),
        as_double(qty_col).alias("q"),
        F.col(id_col).alias("_id"),
    )
    if watermark:
        df = df.withWatermark("event_ts", watermark)
    out = (df.groupBy("symbol", F.window("event_ts", window).alias("w"))
             .agg(F.sum(F.col("p") * F.col("q")).alias("_pv"),
                  F.sum("q").alias("total_volume"),
                  F.count("_id").alias("trade_count")))
    return out.select(
        "symbol",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        safe_div("_pv", "total_volume").alias("vwap"),
        "total_volume", "trade_count",
        F.lit(interval_label).alias("interval_label"),
    )


def vwap_rows(vwap: DataFrame) -> DataFrame:
    """``vwap_aggregations`` result rows: times cut to seconds, version added."""
    return vwap.select(
        "symbol",
        F.date_trunc("second", "window_start").alias("window_start"),
        F.date_trunc("second", "window_end").alias("window_end"),
        "vwap", "total_volume", "trade_count", "interval_label",
        version_of("window_start").alias("version"),
    )


def batch_vwap_range(raw_a: DataFrame, start_ms: int | None = None, end_ms: int | None = None, *,
                     time_col: str = "trade_time", price_col: str = "price",
                     qty_col: str = "quantity") -> DataFrame:
    """Batch VWAP per symbol over ``start_ms <= time < end_ms`` (either bound
    may be omitted). The range filter reaches the Parquet scan."""
    df = raw_a
    if start_ms is not None and end_ms is not None:
        df = df.where(half_open(time_col, F.lit(start_ms), F.lit(end_ms)))
    elif start_ms is not None:
        df = df.where(F.col(time_col) >= start_ms)
    elif end_ms is not None:
        df = df.where(F.col(time_col) < end_ms)
    p, q = as_double(price_col), as_double(qty_col)
    return (df.groupBy("symbol")
              .agg(safe_div(F.sum(p * q), F.sum(q)).alias("batch_vwap")))


def batch_vwap_by_hour(raw_a: DataFrame, *, time_col: str = "trade_time",
                       price_col: str = "price", qty_col: str = "quantity",
                       hour_ms: int = 3_600_000) -> DataFrame:
    """Batch VWAP per symbol and hour ``[h, h + 1 h)``, every hour at once
    (the backfill form of ``batch_vwap_range``)."""
    p, q = as_double(price_col), as_double(qty_col)
    hour = (F.floor(F.col(time_col) / hour_ms) * hour_ms).alias("hour_start_ms")
    return (raw_a.groupBy("symbol", hour)
                 .agg(safe_div(F.sum(p * q), F.sum(q)).alias("batch_vwap")))


def to_ms(t: datetime | str | int) -> int:
    """Python-side helper for range bounds (UTC)."""
    if isinstance(t, int):
        return t
    if isinstance(t, str):
        t = datetime.fromisoformat(t.replace("Z", "+00:00"))
    if t.tzinfo is None:
        from datetime import timezone
        t = t.replace(tzinfo=timezone.utc)
    return int(t.timestamp() * 1000)
