"""Hourly reconciliation run (P6) over the lake and the streamed results.

For the last completed hour before ``now`` (UTC): batch VWAP from the raw
lake table of venue A (date partitions pruned, the time range pushed into the
Parquet scan), the mean of the streamed 5-minute VWAPs of that hour read
through the latest-by-key view, compared per symbol. Results are appended to
``recon_results`` as one batch keyed by the run time, so re-running the same
run replaces its rows instead of duplicating them. Nothing is collected to
the driver.

``refresh_reconciliation`` is the incremental form over stored tables: sums per (symbol, hour) are
kept, only hours that got lake rows or streamed windows since its last run are
compared again, and a later verdict of an hour has a higher version.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark import schemas
from tidemark.functions.columns import safe_div
from tidemark.operators.latest import latest_by_key
from tidemark.operators.reconcile import compare_hours, reconcile, streaming_vwap_by_hour, streaming_vwap_range
from tidemark.operators.vwap import batch_vwap_range
from tidemark.sources.lake import read_raw_path
from tidemark.streaming import commits
from tidemark.streaming.sinks import current_rows, write_batch

HOUR_MS = 3_600_000


def last_completed_hour(now: datetime) -> tuple[datetime, datetime]:
    """``[h - 1 h, h)`` with ``h`` = ``now`` truncated to the hour, UTC."""
    if now.tzinfo is not None:
        now = now.astimezone(timezone.utc).replace(tzinfo=None)
    end = now.replace(minute=0, second=0, microsecond=0)
    return end - timedelta(hours=1), end


def _ms(t: datetime) -> int:
    return int(t.replace(tzinfo=timezone.utc).timestamp() * 1000)


def run_hourly_reconciliation(spark: SparkSession, *, lake_raw_a: str, vwap_results: str,
                              out_path: str | None = None, now: datetime | None = None,
                              tolerance_pct: float = C.RECON_DIFF_PCT,
                              weighted: bool = False) -> tuple[DataFrame, DataFrame]:
    """Run one reconciliation. Returns ``(results, missing)``; when
    ``out_path`` is given the results are also appended there (K5)."""
    now = now or datetime.now(timezone.utc)
    if now.tzinfo is not None:
        now = now.astimezone(timezone.utc).replace(tzinfo=None)
    start, end = last_completed_hour(now)
    batch = batch_vwap_range(read_raw_path(spark, lake_raw_a, "trade_time", _ms(start), _ms(end)))
    vwap = current_rows(spark, vwap_results, schemas.VWAP_AGGREGATIONS, start, end)
    stream = streaming_vwap_range(vwap, start, end, weighted=weighted)
    results, missing = reconcile(batch, stream, run_time=now, window_start=start, window_end=end,
                                 tolerance_pct=tolerance_pct)
    if out_path:
        write_batch(results, int(now.replace(tzinfo=timezone.utc).timestamp()), out_path,
                    schemas.RECON_RESULTS.time)
    return results, missing


def _on(dates: list[str]):
    return commits.date_text().isin(dates) if dates else F.lit(False)


def _dates_between(start_ms: int, end_ms: int) -> list[str]:
    day = 24 * HOUR_MS
    return [datetime.fromtimestamp(k * day / 1000, timezone.utc).date().isoformat() for k in range(start_ms // day, max(start_ms, end_ms - 1) // day + 1)]


def refresh_reconciliation(spark: SparkSession, *, lake_raw_a: str, vwap_results: str, sums_path: str, out_path: str, now: datetime,
                           upto_lake_batch: int | None = None, tolerance_pct: float = C.RECON_DIFF_PCT, weighted: bool = False) -> tuple[DataFrame, DataFrame]:
    """Compare again what changed since the last run; ``(results, missing)`` of this run, the results
    also appended to ``out_path`` as ``recon_results`` rows (read them through ``current_verdicts``).

    The record of a run says which lake and VWAP batches it has read and its ``now``. Lake rows of later batches
    (dates of the batches' records prune the scan) are summed per (symbol, hour) and added to
    ``sums_path``; a sum of an hour is the total of its parts, so no lake row is read twice. Hours to
    compare: those with new sums or new windows, and those that have ended since the last run;
    each only once it has ended. A run that stopped is repeated under its own number: its parts and results are
    replaced, none counts twice. ``upto_lake_batch`` leaves later lake batches to a later run."""
    if now.tzinfo is not None:
        now = now.astimezone(timezone.utc).replace(tzinfo=None)
    done = commits.last_record(spark, out_path) or {"batch": -1, "inputs": {}}
    run, before = done["batch"] + 1, done["inputs"]
    lake_from, vwap_from, ended_from = before.get("lake", -1), before.get("vwap", -1), before.get("now_ms")
    lake_to = commits.committed_batch(spark, lake_raw_a)
    vwap_to = commits.committed_batch(spark, vwap_results)
    if lake_to is None or vwap_to is None:
        raise ValueError("the lake and the VWAP table need commit records")
    lake_to = max(lake_from, lake_to if upto_lake_batch is None else min(lake_to, upto_lake_batch))
    lake_dates = commits.changed_dates(spark, lake_raw_a, "", lake_from, lake_to)
    vwap_dates = commits.changed_dates(spark, vwap_results, "", vwap_from, vwap_to)

    hour = F.floor(F.col("trade_time") / HOUR_MS) * HOUR_MS
    new = (spark.read.parquet(lake_raw_a).where(_on(lake_dates) & (F.col("batch_id") > lake_from) & (F.col("batch_id") <= lake_to))
           .groupBy("symbol", hour.alias("hour_start_ms"))
           .agg(F.sum(F.col("price") * F.col("quantity")).alias("pv"), F.sum("quantity").alias("volume")))
    write_batch(new, run, sums_path, F.timestamp_millis("hour_start_ms"))

    # hours that changed: of this run's parts and of windows in later batches or, if compacted since, in their dates
    windows = spark.read.parquet(vwap_results).where(commits.visible(spark, vwap_results, vwap_to) & _on(vwap_dates)
                                                     & ((F.col("batch_id") > vwap_from) | (F.col("batch_id") < 0)))
    changed = (spark.read.parquet(sums_path).where(F.col("batch_id") == run).select("hour_start_ms")
               .unionByName(windows.select((F.floor(F.unix_millis("window_start") / HOUR_MS) * HOUR_MS).alias("hour_start_ms"))).distinct())
    now_ms = _ms(now)
    ended = F.col("hour_start_ms") + HOUR_MS <= now_ms
    since = [] if ended_from is None else _dates_between(ended_from - HOUR_MS, now_ms)  # dates of hours that ended meanwhile
    dates = sorted({*lake_dates, *vwap_dates, *since})
    lately = F.col("hour_start_ms") + HOUR_MS > (ended_from if ended_from is not None else now_ms)
    due = changed.withColumn("changed", F.lit(True))

    def due_only(df: DataFrame) -> DataFrame:
        return df.where(ended).join(due, "hour_start_ms", "left").where(F.col("changed") | lately).drop("changed")

    sums = spark.read.parquet(sums_path).where((F.col("batch_id") <= run) & _on(dates))
    batch = due_only(sums.groupBy("symbol", "hour_start_ms").agg(F.sum("pv").alias("pv"), F.sum("volume").alias("volume"))).select(
        "symbol", "hour_start_ms", safe_div("pv", "volume").alias("batch_vwap"))
    stored = spark.read.parquet(vwap_results).where(commits.visible(spark, vwap_results, vwap_to) & _on(dates))
    current = latest_by_key(stored, schemas.VWAP_AGGREGATIONS.key, version=schemas.VWAP_AGGREGATIONS.version, tiebreak=("batch_id",))
    stream = due_only(streaming_vwap_by_hour(current, weighted=weighted, hour_ms=HOUR_MS))
    results, missing = compare_hours(batch, stream, run_time=now, tolerance_pct=tolerance_pct, hour_ms=HOUR_MS)
    write_batch(results, run, out_path, schemas.RECON_RESULTS.time, inputs={"lake": lake_to, "vwap": vwap_to, "now_ms": now_ms})
    written = spark.read.parquet(out_path).where(F.col("batch_id") == run)
    return written.drop("batch_id", "event_date"), missing


def current_verdicts(spark: SparkSession, out_path: str) -> DataFrame:
    """The latest verdict of every symbol and hour."""
    rows = spark.read.parquet(out_path).where(commits.visible(spark, out_path))
    return latest_by_key(rows, ["symbol", "window_start"], tiebreak=("batch_id",)).drop("batch_id", "event_date")
