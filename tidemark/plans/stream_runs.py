"""Run the streaming jobs over feeds derived from the given tables.

The derived trades are staged once as time-ordered Parquet files under the
shared folder (range-partitioned, a few files per micro-batch), then each job reads
them as a file stream, a fixed number of files per micro-batch, runs to completion
(``availableNow``) and its sink is read back. Streaming results equal the
batch results minus what the final watermark has not closed yet.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import hashlib

from tidemark.session import data_files, path_exists, path_signature, scratch_path, set_modified, shared_dir
from tidemark.sources import feeds, testfeeds
from tidemark import schemas
from tidemark.operators import reads, whales
from tidemark.plans import reconciliation
from tidemark.sources import lake
from tidemark.streaming import commits, jobs, sinks

BATCHES = 10  # micro-batches that a staged feed is read in
FILES_PER_TRIGGER = 4
RUN_ONCE = {"availableNow": True}


def stage_in_time_order(df: DataFrame, time_col: str, path: str, batches: int = BATCHES, files: int = FILES_PER_TRIGGER) -> str:
    """Write ``df`` in one range-partitioned job as ``batches * files`` files, each
    a span of time, and give the files of each span of ``files`` a common modification
    time, rising with time: a file stream that takes ``files`` files per trigger then
    sees event time advance batch by batch, whatever the size of the feed."""
    spark = df.sparkSession
    df.repartitionByRange(batches * files, time_col).write.parquet(path)
    staged = data_files(spark, path)  # part numbers rise with time
    newest = max((f[2] for f in staged), default=0)
    for k, (name, _, _) in enumerate(staged):
        set_modified(spark, name, newest - 1000 * (batches - k // files))
    return path


def staged_input(spark: SparkSession, sf_dir: str, feed: str) -> str:
    """The staged copy of one derived feed (``trades_a``, ``trades_b``,
    ``raw_a``, ``raw_b``), written once per input (its list of data files) and
    derivation version and reused by later runs. The marker (a one-line table naming the
    data folder) is written last, so a half-written copy is never used."""
    src = f"{sf_dir}/events.parquet"
    sig = f"{src}|{path_signature(spark, src)}|{testfeeds.DERIVATION_VERSION}"
    key = hashlib.sha1(sig.encode()).hexdigest()[:12]
    marker = os.path.join(shared_dir(spark), "staged-feeds", key, feed + ".complete")
    if path_exists(spark, os.path.join(marker, "_SUCCESS")):
        return spark.read.text(marker).first()[0]
    f = testfeeds.load(spark, sf_dir)
    if feed == "trades_a":
        df, col = f["trades_a"], "trade_time"
    elif feed == "trades_b":
        df, col = f["trades_b"], "event_time"
    elif feed in ("raw_a", "raw_b"):
        df = testfeeds.raw_feed_a(f["events"]) if feed == "raw_a" else testfeeds.raw_feed_b(f["events"])
        col = "received_at"
    else:
        raise ValueError(f"unknown feed {feed!r}")
    path = stage_in_time_order(df, col, scratch_path(spark, os.path.join("staged-feeds", key, feed)))
    spark.createDataFrame([(path,)], "path string").coalesce(1).write.mode("overwrite").text(marker)
    return path


def _staged(spark: SparkSession, sf_dir: str, job: str | None = None):
    """Both staged feeds as streams, narrowed to the columns that ``job`` reads
    (all columns and both feeds without a job)."""
    cols_a, cols_b = jobs.INPUT_COLUMNS.get(job, (None, None))
    sa = sb = None
    if cols_a is None or cols_a:
        sa = feeds.read_trades_a(spark, staged_input(spark, sf_dir, "trades_a"), stream=True,
                                 max_files_per_trigger=FILES_PER_TRIGGER, columns=cols_a)
    if cols_b is None or cols_b:
        sb = feeds.read_trades_b(spark, staged_input(spark, sf_dir, "trades_b"), stream=True,
                                 max_files_per_trigger=FILES_PER_TRIGGER, columns=cols_b)
    return sa, sb


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where(commits.visible(spark, path)).drop("batch_id", "event_date")


def run_vwap(spark: SparkSession, sf_dir: str, *, window: str, label: str) -> DataFrame:
    root = scratch_path(spark, "stream-vwap")
    sa, _ = _staged(spark, sf_dir, "vwap")
    q = jobs.vwap_job(sa, os.path.join(root, "out"), checkpoint=os.path.join(root, "ckpt"),
                      window=window, interval_label=label, trigger=RUN_ONCE)
    q.awaitTermination()
    return _read(spark, os.path.join(root, "out"))


def run_whales(spark: SparkSession, sf_dir: str, *, normalise: bool = False) -> DataFrame:
    root = scratch_path(spark, "stream-whales")
    sa, sb = _staged(spark, sf_dir, "whales")
    q = jobs.whale_job(sa, sb, os.path.join(root, "out"), checkpoint=os.path.join(root, "ckpt"),
                       normalise=normalise, trigger=RUN_ONCE)
    q.awaitTermination()
    return _read(spark, os.path.join(root, "out"))


def run_arbitrage(spark: SparkSession, sf_dir: str, *, half_width_ms: int, idle_ms: int | None = None) -> DataFrame:
    root = scratch_path(spark, "stream-arbitrage")
    sa, sb = _staged(spark, sf_dir, "arbitrage")
    q = jobs.arbitrage_job(sa, sb, os.path.join(root, "out"), checkpoint=os.path.join(root, "ckpt"),
                           half_width_ms=half_width_ms, idle_ms=idle_ms, trigger=RUN_ONCE)
    q.awaitTermination()
    return _read(spark, os.path.join(root, "out"))


def run_double_bottom(spark: SparkSession, sf_dir: str, *, within_ms: int,
                      after_match: str = "past_last_row") -> DataFrame:
    root = scratch_path(spark, "stream-double-bottom")
    sa, _ = _staged(spark, sf_dir, "double_bottom")
    q = jobs.double_bottom_job(sa, os.path.join(root, "out"), checkpoint=os.path.join(root, "ckpt"),
                               within_ms=within_ms, after_match=after_match, trigger=RUN_ONCE)
    q.awaitTermination()
    return _read(spark, os.path.join(root, "out"))


def run_lake(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    root = scratch_path(spark, "stream-lake")
    sa, sb = _staged(spark, sf_dir)
    qa, qb = jobs.lake_job(sa, sb, os.path.join(root, "lake"), checkpoint=os.path.join(root, "ckpt"),
                           trigger=RUN_ONCE)
    qa.awaitTermination()
    qb.awaitTermination()
    return _read(spark, os.path.join(root, "lake", lake.RAW_A_TABLE)), _read(spark, os.path.join(root, "lake", lake.RAW_B_TABLE))


def run_ingest(spark: SparkSession, sf_dir: str, venue: str) -> tuple[DataFrame, DataFrame]:
    root = scratch_path(spark, f"stream-ingest-{venue}")
    src = feeds.read_raw(spark, staged_input(spark, sf_dir, f"raw_{venue}"), stream=True,
                         max_files_per_trigger=FILES_PER_TRIGGER)
    q = jobs.ingest_job(src, venue, os.path.join(root, "out"), checkpoint=os.path.join(root, "ckpt"),
                        trigger=RUN_ONCE)
    q.awaitTermination()
    out = os.path.join(root, "out")
    return tuple(commits.committed_rows(spark, out, os.path.join(out, f"{kind}_{venue}")).drop("batch_id") for kind in ("trades", "dead_letter"))


JOBS_DB = "tidemark_jobs"


def catalog_tables(spark: SparkSession, root: str) -> str:
    """The database of the catalog runs, with its tables (external, data stays) placed at ``root``."""
    lake.create_database(spark, JOBS_DB, location=os.path.join(shared_dir(spark), JOBS_DB))
    for name in (lake.RAW_A_TABLE, lake.RAW_B_TABLE, *schemas.RESULT_TABLES):
        spark.sql(f"DROP TABLE IF EXISTS {JOBS_DB}.{name}")
    lake.create_lake_tables(spark, JOBS_DB, root=root)
    lake.create_result_tables(spark, JOBS_DB, root=root)
    return JOBS_DB


def run_catalog(spark: SparkSession, sf_dir: str, start_ms: int, end_ms: int, start, end) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The lake and VWAP jobs write tables of the catalog; both raw ranges and the result range read from it."""
    root = scratch_path(spark, "stream-catalog")
    db = catalog_tables(spark, root)
    sa, sb = _staged(spark, sf_dir)
    queries = [*jobs.lake_job(sa, sb, root, checkpoint=os.path.join(root, "ckpt-lake"), trigger=RUN_ONCE, catalog=db),
               jobs.vwap_job(_staged(spark, sf_dir, "vwap")[0], os.path.join(root, schemas.VWAP_AGGREGATIONS.name),
                             checkpoint=os.path.join(root, "ckpt-vwap"), trigger=RUN_ONCE, catalog=db)]
    for q in queries:
        q.awaitTermination()
    return (lake.read_raw_range(spark, f"{db}.{lake.RAW_A_TABLE}", "trade_time", start_ms, end_ms),
            lake.read_raw_range(spark, f"{db}.{lake.RAW_B_TABLE}", "event_time", start_ms, end_ms),
            lake.read_result_range(spark, f"{db}.{schemas.VWAP_AGGREGATIONS.name}", start, end))


def run_compacted(spark: SparkSession, sf_dir: str, *, first_before: str, then_before: str) -> DataFrame:
    """5-minute VWAP windows written batch by batch, compacted twice (the second run finds new closed dates
    only) and read back as current rows."""
    root = scratch_path(spark, "stream-compacted")
    out = os.path.join(root, "out")
    jobs.vwap_job(_staged(spark, sf_dir, "vwap")[0], out, checkpoint=os.path.join(root, "ckpt"), trigger=RUN_ONCE).awaitTermination()
    for before in (first_before, then_before):
        sinks.compact(spark, out, schemas.VWAP_AGGREGATIONS, before)
    sinks.remove_superseded(spark, out)
    return sinks.current_rows(spark, out, schemas.VWAP_AGGREGATIONS)


def run_reconciliation(spark: SparkSession, sf_dir: str, *, run_times, first_lake_batch: int) -> DataFrame:
    """The lake and the VWAP windows as the jobs write them, reconciled incrementally: a first run
    when the lake has its batches up to ``first_lake_batch``, a second one for what came later."""
    root = scratch_path(spark, "stream-reconciliation")
    sa, sb = _staged(spark, sf_dir)
    for q in (*jobs.lake_job(sa, sb, os.path.join(root, "lake"), checkpoint=os.path.join(root, "ckpt-lake"), trigger=RUN_ONCE),
              jobs.vwap_job(_staged(spark, sf_dir, "vwap")[0], os.path.join(root, "vwap"), checkpoint=os.path.join(root, "ckpt-vwap"), trigger=RUN_ONCE)):
        q.awaitTermination()
    out = os.path.join(root, "recon")
    for now, upto in zip(run_times, (first_lake_batch, None)):
        reconciliation.refresh_reconciliation(spark, lake_raw_a=os.path.join(root, "lake", lake.RAW_A_TABLE), vwap_results=os.path.join(root, "vwap"),
                                              sums_path=os.path.join(root, "sums"), out_path=out, now=now, upto_lake_batch=upto)
    return reconciliation.current_verdicts(spark, out)


def run_latest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream of whale alerts of both venues as changes of the current row per key, read as the view."""
    root = scratch_path(spark, "stream-latest")
    sa, sb = _staged(spark, sf_dir, "whales")
    rows = whales.whale_alert_rows(whales.whale_trades(sa, sb, normalise=True))
    jobs.latest_job(rows, schemas.WHALE_ALERTS, os.path.join(root, "out"), checkpoint=os.path.join(root, "ckpt"), trigger=RUN_ONCE).awaitTermination()
    return sinks.current_rows(spark, os.path.join(root, "out"), schemas.WHALE_ALERTS)


def run_recent_alerts(spark: SparkSession, sf_dir: str, start, end, n: int) -> DataFrame:
    """The newest alerts of the table that the whale job writes."""
    root = scratch_path(spark, "stream-recent")
    sa, sb = _staged(spark, sf_dir, "whales")
    out = os.path.join(root, "out")
    jobs.whale_job(sa, sb, out, checkpoint=os.path.join(root, "ckpt"), normalise=True, trigger=RUN_ONCE).awaitTermination()
    return reads.stored_recent_alerts(spark, out, start, end, n=n)
