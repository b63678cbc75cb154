"""Streaming jobs: each wires a source, an operator and a sink, and returns the
started query.

Every job takes streaming DataFrames (see ``sources.feeds``), an output folder
and a checkpoint folder (default: under ``spark.checkpoint.dir``). The
checkpoint holds source offsets, the commit log and operator state
(RocksDB), so a restarted job resumes without loss or duplicates; the
``foreachBatch`` sinks are idempotent per batch id, and readers take a batch once its
commit record is written. With ``catalog`` (a database whose tables were created at the
output's place, see ``sources.lake``), new partitions are added to the job's table there.
"""

from __future__ import annotations

import hashlib
import os
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import config as C
from tidemark import schemas
from tidemark.operators import ingest
from tidemark.operators.double_bottom import double_bottom_rows
from tidemark.operators.interval_join import arbitrage_rows, arbitrage_signals
from tidemark.operators.vwap import vwap_by_window, vwap_rows
from tidemark.operators.whales import whale_alert_rows, whale_trades
from tidemark.session import shared_dir
from tidemark.sources.lake import RAW_A_TABLE, RAW_B_TABLE, raw_a_projection, raw_b_projection
from tidemark.streaming.double_bottom_state import stream_double_bottom
from tidemark.streaming.sinks import lake_table_writer, multi_writer, result_table_writer

#: Columns that each job reads of its inputs (venue A, venue B); sources are
#: narrowed to them (``feeds.read_trades_a(..., columns=)``).
INPUT_COLUMNS = {
    "vwap": (("symbol", "trade_id", "price", "quantity", "trade_time"), ()),
    "whales": (("symbol", "price", "quantity", "trade_time", "is_buyer_maker"), ("product_id", "price", "size", "side", "event_time")),
    "arbitrage": (("symbol", "price", "trade_time"), ("product_id", "price", "event_time")),
    "double_bottom": (("symbol", "trade_id", "price", "trade_time"), ()),
}

DEFAULT_TRIGGER = {"processingTime": "10 seconds"}

#: Dates of a micro-batch that a task writes side by side; further ones are sorted first. Without
#: it every row is sorted by date before it is written.
_OPEN_DATES = {"spark.sql.maxConcurrentOutputFileWriters": "6"}

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_conf(spark: SparkSession, state_partitions: int | None = None) -> dict[str, str]:
    """Settings a stateful query fixes in its checkpoint at the first start:
    the number of state partitions (default: the cluster's parallelism, not
    the batch shuffle setting) and the RocksDB state store with changelog
    checkpointing."""
    n = state_partitions or spark.sparkContext.defaultParallelism
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


@contextmanager
def _session_conf(spark: SparkSession, conf: dict[str, str]):
    """Apply ``conf`` while a query starts. The query runs on a copy of the
    session taken at start, so the caller's settings are restored after."""
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _ckpt(df: DataFrame, checkpoint: str | None, name: str, out_path: str) -> str:
    """The given checkpoint, else one under ``spark.checkpoint.dir`` that is the
    same at every start of the same job with the same output, so a restart resumes."""
    if checkpoint:
        return checkpoint
    out = hashlib.sha256(out_path.encode()).hexdigest()[:12]
    return os.path.join(shared_dir(df.sparkSession), "streams", f"{name}-{out}")


def _start(rows: DataFrame, writer, checkpoint: str, name: str, trigger: dict | None,
           state_partitions: int | None = None, conf: dict[str, str] | None = None, mode: str = "append") -> StreamingQuery:
    spark = rows.sparkSession
    with _session_conf(spark, {**stream_conf(spark, state_partitions), **_OPEN_DATES, **(conf or {})}):
        return (rows.writeStream.foreachBatch(writer)
                    .outputMode(mode)
                    .option("checkpointLocation", checkpoint)
                    .queryName(name)
                    .trigger(**(trigger or DEFAULT_TRIGGER))
                    .start())


def _result_writer(out_path: str, table: schemas.ResultTable, catalog: str | None):
    return result_table_writer(out_path, table, f"{catalog}.{table.name}" if catalog else None)


def vwap_job(trades_a: DataFrame, out_path: str, *, checkpoint: str | None = None,
             window: str = C.VWAP_WINDOW, interval_label: str = C.VWAP_INTERVAL_LABEL,
             watermark: str = C.WATERMARK_DELAY, trigger: dict | None = None, catalog: str | None = None) -> StreamingQuery:
    """Windowed VWAP; each window is written once, after the watermark
    passes its end."""
    rows = vwap_rows(vwap_by_window(trades_a, window=window, interval_label=interval_label,
                                    watermark=watermark))
    return _start(rows, _result_writer(out_path, schemas.VWAP_AGGREGATIONS, catalog),
                  _ckpt(trades_a, checkpoint, "vwap", out_path), "vwap", trigger)


def whale_job(trades_a: DataFrame, trades_b: DataFrame, out_path: str, *,
              checkpoint: str | None = None, normalise: bool = False,
              thresholds: dict[str, float] | None = None, trigger: dict | None = None, catalog: str | None = None) -> StreamingQuery:
    """Stateless union and threshold filter of both venues."""
    rows = whale_alert_rows(whale_trades(trades_a, trades_b, thresholds=thresholds, normalise=normalise))
    return _start(rows, _result_writer(out_path, schemas.WHALE_ALERTS, catalog),
                  _ckpt(trades_a, checkpoint, "whales", out_path), "whales", trigger)


def arbitrage_job(trades_a: DataFrame, trades_b: DataFrame, out_path: str, *,
                  checkpoint: str | None = None, half_width_ms: int = C.JOIN_HALF_WIDTH_MS,
                  min_spread_pct: float = C.SPREAD_PCT_MIN, watermark: str = C.WATERMARK_DELAY,
                  watermark_policy: str | None = None, idle_ms: int | None = None, trigger: dict | None = None,
                  catalog: str | None = None) -> StreamingQuery:
    """Watermarked interval join of the two venues and the spread filter.
    Join state is kept per (symbol, time bucket) and dropped once the
    watermark is more than the half width past it.

    ``watermark_policy`` (R3): with two inputs Spark keeps one watermark,
    the slower input's (``"min"``, default) or the faster's (``"max"``: an
    idle venue does not hold results back, its late rows are dropped). It is
    fixed in the checkpoint at the first start.

    ``idle_ms`` (R3) is the finer way: each venue's watermark also follows the other venue's event time less
    ``idle_ms``, so a silent venue holds the state back by that at most, and its rows that
    are late by less than ``idle_ms`` and the delay still join."""
    conf = {"spark.sql.streaming.multipleWatermarkPolicy": watermark_policy} if watermark_policy else {}
    rows = arbitrage_rows(arbitrage_signals(trades_a, trades_b, half_width_ms=half_width_ms,
                                            min_spread_pct=min_spread_pct, watermark=watermark, idle_ms=idle_ms))
    return _start(rows, _result_writer(out_path, schemas.ARBITRAGE_SIGNALS, catalog),
                  _ckpt(trades_a, checkpoint, "arbitrage", out_path), "arbitrage", trigger, conf=conf)


def double_bottom_job(trades_a: DataFrame, out_path: str, *, checkpoint: str | None = None,
                      within_ms: int = C.PATTERN_WITHIN_MS, after_match: str = "past_last_row",
                      watermark: str = C.WATERMARK_DELAY, trigger: dict | None = None,
                      catalog: str | None = None) -> StreamingQuery:
    """Stateful pattern matcher per symbol."""
    rows = double_bottom_rows(stream_double_bottom(trades_a, within_ms=within_ms,
                                                   after_match=after_match, watermark=watermark))
    return _start(rows, _result_writer(out_path, schemas.DOUBLE_BOTTOM_SIGNALS, catalog),
                  _ckpt(trades_a, checkpoint, "double_bottom", out_path), "double_bottom", trigger)


def latest_job(rows: DataFrame, table: schemas.ResultTable, out_path: str, *, checkpoint: str | None = None, ttl: str = "1 day",
               trigger: dict | None = None, catalog: str | None = None) -> StreamingQuery:
    """A6 on a stream of result rows: the current row per key as changes. Each micro-batch
    appends the keys whose current row changed in it, so the latest-by-key view over the
    output equals that over all input so far.

    State holds one row per key; the key's time column has a watermark of ``ttl``, past which a key is
    forgotten and rows for it are dropped as late. A row that repeats the current one is no change."""
    rest = [f.name for f in table.schema.fields if f.name not in table.key and f.name != table.version]
    now = F.unix_micros(F.current_timestamp())  # one value per micro-batch, the same when it is replayed
    kept = (rows.select(*[f.name for f in table.schema.fields], (-now).alias("_seen")).withWatermark(table.time, ttl)
            .groupBy(*table.key).agg(F.max(F.struct(table.version, *rest, "_seen")).alias("_r")))
    changed = kept.where(F.col("_r._seen") == -now).select(*table.key, "_r.*").drop("_seen")
    return _start(changed, _result_writer(out_path, table, catalog), _ckpt(rows, checkpoint, f"latest_{table.name}", out_path),
                  f"latest_{table.name}", trigger, mode="update")


def lake_job(trades_a: DataFrame, trades_b: DataFrame, lake_root: str, *, checkpoint: str | None = None,
             trigger: dict | None = None, catalog: str | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """P5: both feeds appended to the raw lake tables (by date and batch),
    each with its own checkpoint and commit records."""
    base = _ckpt(trades_a, checkpoint, "lake", lake_root)

    def start(rows, name, time_col, venue):
        writer = lake_table_writer(os.path.join(lake_root, name), time_col, f"{catalog}.{name}" if catalog else None)
        return _start(rows, writer, os.path.join(base, venue), f"lake_{venue}", trigger or {"processingTime": "60 seconds"})

    return (start(raw_a_projection(trades_a), RAW_A_TABLE, "trade_time", "a"),
            start(raw_b_projection(trades_b), RAW_B_TABLE, "event_time", "b"))


def ingest_job(raw: DataFrame, venue: str, out_root: str, *, checkpoint: str | None = None,
               trigger: dict | None = None) -> StreamingQuery:
    """Raw messages of one venue -> typed trades and dead letters, both
    written from one persisted copy of each micro-batch's parsed rows and committed together."""
    parse, split = ((ingest.parsed_feed_a, ingest.split_feed_a) if venue == "a"
                    else (ingest.parsed_feed_b, ingest.split_feed_b))
    writer = multi_writer({
        "trades": (lambda rows: split(rows)[0], os.path.join(out_root, f"trades_{venue}")),
        "dead_letter": (lambda rows: split(rows)[1], os.path.join(out_root, f"dead_letter_{venue}")),
    }, prepare=parse, root=out_root)
    return _start(raw, writer, _ckpt(raw, checkpoint, f"ingest_{venue}", out_root), f"ingest_{venue}", trigger)
