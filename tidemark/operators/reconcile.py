"""Reconciliation of streamed VWAP results against a batch recomputation.

For a time range ``[start, end)``: batch VWAP per symbol from the lake (A4),
the unweighted mean of the streamed window VWAPs inside the range (A5), a
full outer join on symbol (J3), ``diff_pct = |batch - stream| / batch * 100``
and ``ALERT`` above the tolerance (Q1). A range where either side has no rows
gives no results (Q2); its rows go to the ``missing`` output with the reason
``no_batch_rows`` or ``no_streamed_rows``. So do, in other ranges, symbols
present on one side only (``batch``, ``stream``: the side that lacks them) and
rows whose ``diff_pct`` is undefined (``undefined_diff``: batch VWAP 0). ``reconcile_hourly`` runs the same logic for every completed hour at
once, as one plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.functions.columns import safe_div


def streaming_vwap_range(vwap_rows: DataFrame, start, end, *, weighted: bool = False) -> DataFrame:
    """Mean of window VWAPs with ``window_start >= start`` and ``window_end <= end``.
    ``weighted=True`` weights each window by its volume."""
    v = vwap_rows.where((F.col("window_start") >= F.lit(start)) & (F.col("window_end") <= F.lit(end)))
    return v.groupBy("symbol").agg(_stream_mean(weighted).alias("streaming_vwap"))


def _stream_mean(weighted: bool):
    if weighted:
        return safe_div(F.sum(F.col("vwap") * F.col("total_volume")), F.sum("total_volume"))
    return F.avg("vwap")


def _compare(joined: DataFrame, tolerance_pct: float) -> DataFrame:
    diff = safe_div(F.abs(F.col("batch_vwap") - F.col("streaming_vwap")), F.col("batch_vwap")) * F.lit(100.0)
    return joined.withColumn("diff_pct", diff).withColumn(
        "status", F.when(F.col("diff_pct") > F.lit(tolerance_pct), F.lit(C.STATUS_ALERT))
                   .otherwise(F.lit(C.STATUS_OK)))


def _with_reason(j: DataFrame, key: str) -> DataFrame:
    """Q2: add ``reason``, null for the rows that give a result. ``j`` is the
    joined per-symbol aggregates with the side flags ``has_batch`` and
    ``has_stream``, so a window group is one range's symbols; the inputs are
    read once (no second branch over them)."""
    w = Window.partitionBy(key)
    any_row = lambda c: F.max(F.coalesce(F.col(c), F.lit(False))).over(w)
    j = j.withColumn("_b", any_row("has_batch")).withColumn("_s", any_row("has_stream"))
    reason = (F.when(~F.col("_b"), F.lit("no_batch_rows"))
               .when(~F.col("_s"), F.lit("no_streamed_rows"))
               .when(F.col("has_batch").isNull(), F.lit("batch"))
               .when(F.col("has_stream").isNull(), F.lit("stream"))
               .when(F.col("diff_pct").isNull(), F.lit("undefined_diff")))
    return j.withColumn("reason", reason)


def reconcile(batch: DataFrame, stream: DataFrame, *, run_time, window_start, window_end,
              tolerance_pct: float = C.RECON_DIFF_PCT) -> tuple[DataFrame, DataFrame]:
    """One range. ``batch``: (symbol, batch_vwap); ``stream``: (symbol, streaming_vwap).
    Returns ``(results, missing)``."""
    key = F.lit(window_start).cast("timestamp").alias("_range")
    b = batch.select(key, "symbol", "batch_vwap", F.lit(True).alias("has_batch"))
    s = stream.select(key, "symbol", "streaming_vwap", F.lit(True).alias("has_stream"))
    j = _with_reason(_compare(b.join(s, ["_range", "symbol"], "full_outer"), tolerance_pct), "_range")
    rt = F.lit(run_time).cast("timestamp")
    ok = F.col("reason").isNull()
    results = j.where(ok).select(
        rt.alias("run_time"), F.lit(window_start).cast("timestamp").alias("window_start"),
        F.lit(window_end).cast("timestamp").alias("window_end"), "symbol",
        "streaming_vwap", "batch_vwap", "diff_pct", "status",
        F.unix_seconds(rt).alias("version"))
    missing = j.where(~ok).select("symbol", "streaming_vwap", "batch_vwap", "reason")
    return results, missing


def reconcile_hourly(raw_a: DataFrame, vwap_rows: DataFrame, *, run_time,
                     tolerance_pct: float = C.RECON_DIFF_PCT, weighted: bool = False,
                     hour_ms: int = 3_600_000) -> tuple[DataFrame, DataFrame]:
    """Every hour ``[h, h + 1 h)`` reconciled at once.

    ``raw_a``: lake rows (symbol, price, quantity, trade_time ms);
    ``vwap_rows``: streamed windows (symbol, window_start, window_end, vwap,
    total_volume). Windows are assigned to the hour holding their start and
    kept only when they also end inside it. Both sides are aggregated before
    the join (one row per symbol and hour), so the join and the per-hour
    emptiness test handle small inputs whatever the trade volume."""
    from tidemark.operators.vwap import batch_vwap_by_hour

    return compare_hours(batch_vwap_by_hour(raw_a, hour_ms=hour_ms), streaming_vwap_by_hour(vwap_rows, weighted=weighted, hour_ms=hour_ms),
                         run_time=run_time, tolerance_pct=tolerance_pct, hour_ms=hour_ms)


def streaming_vwap_by_hour(vwap_rows: DataFrame, *, weighted: bool = False, hour_ms: int = 3_600_000) -> DataFrame:
    """(symbol, hour_start_ms, streaming_vwap) over windows that lie inside one hour."""
    h0 = F.floor(F.unix_millis("window_start") / hour_ms) * hour_ms
    return (vwap_rows.where(F.unix_millis("window_end") <= h0 + hour_ms)
                     .groupBy("symbol", h0.alias("hour_start_ms"))
                     .agg(_stream_mean(weighted).alias("streaming_vwap")))


def compare_hours(batch: DataFrame, stream: DataFrame, *, run_time, tolerance_pct: float = C.RECON_DIFF_PCT,
                  hour_ms: int = 3_600_000) -> tuple[DataFrame, DataFrame]:
    """``(results, missing)`` of aggregates per (symbol, hour_start_ms): ``batch_vwap`` and ``streaming_vwap``."""
    b = batch.withColumn("has_batch", F.lit(True))
    s = stream.withColumn("has_stream", F.lit(True))
    j = _with_reason(_compare(b.join(s, ["symbol", "hour_start_ms"], "full_outer"), tolerance_pct), "hour_start_ms")
    rt = F.lit(run_time).cast("timestamp")
    ok = F.col("reason").isNull()
    results = j.where(ok).select(
        rt.alias("run_time"),
        F.timestamp_millis("hour_start_ms").alias("window_start"),
        F.timestamp_millis(F.col("hour_start_ms") + hour_ms).alias("window_end"),
        "symbol", "streaming_vwap", "batch_vwap", "diff_pct", "status",
        F.unix_seconds(rt).alias("version"))
    missing = j.where(~ok).select(
        F.timestamp_millis("hour_start_ms").alias("window_start"), "symbol",
        "streaming_vwap", "batch_vwap", "reason")
    return results, missing
