"""Dashboard reads over the result tables: time-range, closed at both ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import closed, metric_label
from tidemark.operators.latest import latest_by_key
from tidemark.schemas import WHALE_ALERTS, ResultTable
from tidemark.session import folder_names
from tidemark.streaming import commits


def top_recent_alerts(alerts: DataFrame, start, end, *, n: int = 100,
                      time_col: str = "event_time") -> DataFrame:
    """Newest ``n`` alerts with ``start <= time <= end`` (T1), newest first.

    Equal times are ordered by the remaining columns so the cut is
    deterministic. Planned as a per-partition top-n plus one merge
    (TakeOrderedAndProject), never a full sort."""
    cols = ["event_time", "symbol", "price", "quantity", "trade_value", "exchange", "side"]
    tie = [F.col(c).desc() for c in ("symbol", "exchange", "side", "price", "quantity")]
    return (alerts.where(closed(time_col, F.lit(start), F.lit(end)))
                  .select(*cols)
                  .orderBy(F.col(time_col).desc(), *tie)
                  .limit(n))


def vwap_series(vwap: DataFrame, start, end, *, suffix: str = " VWAP") -> DataFrame:
    """``(time, metric, vwap)`` for windows starting in ``[start, end]`` (T2),
    ordered by time."""
    return (vwap.where(closed("window_start", F.lit(start), F.lit(end)))
                .select(F.col("window_start").alias("time"),
                        metric_label("symbol", suffix).alias("metric"),
                        "vwap")
                .orderBy("time", "metric"))


def stored_recent_alerts(spark: SparkSession, path: str, start, end, *, n: int = 100, table: ResultTable = WHALE_ALERTS) -> DataFrame:
    """T1 over a stored table: the newest ``n`` current alerts in the range, without opening older dates.

    Dates of the range are visited from the newest; once the dates so far hold ``n`` alerts the
    rest cannot be among the newest. A visit counts one date's rows (at most ``n`` of them); the result is
    read from the dates that were visited only."""
    start, end = (str(x)[:19] for x in (start, end))
    names = sorted((x.partition("=")[2] for x in folder_names(spark, path) if x.startswith("event_date=")), reverse=True)
    dates = [d for d in names if d != commits.NO_DATE and start[:10] <= d <= end[:10]]
    held, opened = 0, []
    for date in dates:
        opened.append(date)
        held += _of_dates(spark, path, table, [date]).where(closed(table.time, *_times(start, end))).limit(n - held).count()
        if held >= n:
            break
    return top_recent_alerts(_of_dates(spark, path, table, opened), *_times(start, end), n=n, time_col=table.time)


def _times(*texts: str):
    return [F.lit(x).cast("timestamp") for x in texts]


def _of_dates(spark: SparkSession, path: str, table: ResultTable, dates: list[str]) -> DataFrame:
    """Current rows of some dates. The time is part of the key, so versions of a row share its date."""
    rows = spark.read.parquet(path).where(commits.date_text().isin(dates) if dates else F.lit(False)).where(commits.visible(spark, path))
    return latest_by_key(rows, table.key, version=table.version, tiebreak=("batch_id",)).drop("batch_id", "event_date")
