"""Sinks for the streaming jobs (K1-K6).

Tables are append-only Parquet folders partitioned by ``event_date`` (the
date of the table's time column) and ``batch_id``. ``foreachBatch`` writes one
micro-batch with dynamic partition overwrite, so a batch replayed after a
failure replaces its own partitions instead of adding duplicates, and then the
batch's commit record (``streaming.commits``): readers take recorded batches only. With a
catalog table, the batch's partitions are added to it last. A failed write fails the batch, and the query
retries it from the checkpoint; no row is dropped. Readers use ``current_rows``
(the latest-by-key view, for a time range if given); ``compact`` merges
the batches of closed dates.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_by_key
from tidemark.schemas import ResultTable
from tidemark.session import delete_path, folder_names
from tidemark.streaming import commits


def _write_rows(df: DataFrame, batch_id: int, path: str, date: Column | None) -> list[str]:
    """Append the rows of one batch, replacing an earlier attempt; the dates they have."""
    out = df.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
    parts, dates = ["batch_id"], None
    if date is not None:
        dates = Observation()
        out = out.withColumn("event_date", date).observe(dates, commits.date_texts().alias("dates"))
        parts = ["event_date", "batch_id"]
    (out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*parts)
        .parquet(path))
    return list(dates.get["dates"]) if dates is not None else []


def write_batch(df: DataFrame, batch_id: int, path: str, time_col: str | Column | None = None, *,
                catalog_table: str | None = None, inputs: dict[str, int] | None = None) -> None:
    """K1/K2/K5: bulk append of one batch, idempotent per ``batch_id`` (a batch
    is a fixed set of rows, so a replay has the same dates), and its commit record. With
    ``time_col`` (a timestamp) rows are also partitioned by its date; ``catalog_table``
    names a table at the same location that gets the new partitions."""
    date = None if time_col is None else F.to_date(time_col)
    dates = _write_rows(df, batch_id, path, date)
    commits.commit(df.sparkSession, path, batch_id, {"": dates}, inputs)
    if catalog_table:
        commits.register(df.sparkSession, catalog_table, dates, batch_id)


def result_table_writer(path: str, table: ResultTable | None = None, catalog_table: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function writing rows of ``table`` to ``path``."""
    cols = [f.name for f in table.schema.fields] if table else None

    def _write(df: DataFrame, batch_id: int) -> None:
        if table:
            write_batch(df.select(*cols), batch_id, path, table.time, catalog_table=catalog_table)
        else:
            write_batch(df, batch_id, path)

    return _write


def lake_table_writer(path: str, time_col: str, catalog_table: str | None = None) -> Callable[[DataFrame, int], None]:
    """K3: a ``foreachBatch`` function appending raw rows (time in epoch ms) to a lake table."""
    def _write(df: DataFrame, batch_id: int) -> None:
        write_batch(df, batch_id, path, F.timestamp_millis(F.col(time_col)), catalog_table=catalog_table)

    return _write


def multi_writer(writers: dict[str, tuple[Callable[[DataFrame], DataFrame], str]],
                 prepare: Callable[[DataFrame], DataFrame] = lambda df: df, *, root: str) -> Callable[[DataFrame, int], None]:
    """K4: several outputs of one micro-batch (e.g. trades and dead letters),
    all derived from one persisted copy of ``prepare(batch)``, so that the
    shared work (parsing) runs once for all of them. One record under ``root`` commits all:
    ``commits.committed_rows(spark, root, path)`` shows a batch in every output or in none."""

    def _write(df: DataFrame, batch_id: int) -> None:
        ready = prepare(df).persist()
        try:
            done = {name: _write_rows(derive(ready), batch_id, path, None) for name, (derive, path) in writers.items()}
            commits.commit(df.sparkSession, root, batch_id, done)
        finally:
            ready.unpersist()

    return _write


def stored_rows(spark: SparkSession, path: str, table: ResultTable, start=None, end=None) -> DataFrame:
    """All versions in a table with ``start <= time < end``: of recorded batches, and of the
    current generation of compacted dates. Dates prune partitions, the times are pushed into the scan."""
    rows = spark.read.parquet(path)
    time = F.col(table.time)
    if start is not None:
        rows = rows.where((F.col("event_date") >= F.to_date(F.lit(start).cast("timestamp"))) & (time >= F.lit(start).cast("timestamp")))
    if end is not None:
        rows = rows.where((F.col("event_date") <= F.to_date(F.lit(end).cast("timestamp"))) & (time < F.lit(end).cast("timestamp")))
    return rows.where(commits.visible(spark, path))


def current_rows(spark: SparkSession, path: str, table: ResultTable, start=None, end=None) -> DataFrame:
    """K6 read side: the current row per key (highest version; ties go to the
    later batch, then the other columns), of a time range if given. The time is
    part of the key, so the range is cut before the versions are compared."""
    return latest_by_key(stored_rows(spark, path, table, start, end), table.key, version=table.version,
                         tiebreak=("batch_id",)).drop("batch_id", "event_date")


def compact(spark: SparkSession, path: str, table: ResultTable, before, *, catalog_table: str | None = None) -> list[str]:
    """K6 merge: the rows of closed dates (before the date ``before``; no job writes to them any more, but
    late rows may come) become their latest-by-key view in one folder per date, a new generation.

    Only dates that got batches since they were last compacted are read and written; they are returned. The
    new state makes all of them current in one step. A run that stops before it leaves folders that no reader
    takes and the next run removes; after it, only tidying is left. Folders that this run
    supersedes stay for readers that have begun; the next run, or ``remove_superseded``, removes them."""
    remove_superseded(spark, path, catalog_table=catalog_table)
    last, old = commits.committed_batch(spark, path), commits.state(spark, path)
    if last is None or last < 0:
        return []
    seen = {d: covers for d, (_, covers) in old["dates"].items()}
    by_date = commits.records(spark, path).where(F.col("output") == "").groupBy("date").agg(F.max("batch").alias("last")).collect()  # one row per date
    dates = sorted(r["date"] for r in by_date if r["date"] < str(before) and r["last"] > seen.get(r["date"], -1))
    if not dates:
        return []
    generation = old["generation"] + 1
    stored = stored_rows(spark, path, table).where(commits.date_text().isin(dates))
    view = latest_by_key(stored, table.key, version=table.version, tiebreak=("batch_id",))
    _delete_all(spark, [f"{path}/event_date={d}/batch_id={-generation}" for d in dates])  # of a run that stopped
    (view.select(*[f.name for f in table.schema.fields], "event_date", F.lit(-generation).cast("long").alias("batch_id"))
         .hint("rebalance", "event_date")  # one file per date, several where a date is large
         .write.mode("append").partitionBy("event_date", "batch_id").parquet(path))
    if catalog_table:
        commits.register(spark, catalog_table, dates, -generation)
    commits.put_state(spark, path, {
        "generation": generation, "dates": {**old["dates"], **{d: [generation, last] for d in dates}},
        "superseded": {d: [old["dates"].get(d, [0, -1])[0], last] for d in dates}})
    commits.drop_used_records(spark, path)
    return dates


def remove_superseded(spark: SparkSession, path: str, *, catalog_table: str | None = None) -> None:
    """Remove the folders that the last compaction has superseded."""
    current = commits.state(spark, path)
    gone = []
    for date, (_, covers) in current["superseded"].items():
        for name in folder_names(spark, f"{path}/event_date={date}"):
            batch = int(name.partition("=")[2]) if name.startswith("batch_id=") else None
            if batch is not None and (0 <= batch <= covers or -current["dates"][date][0] < batch < 0):
                gone.append((date, batch))
    if catalog_table:
        commits.unregister(spark, catalog_table, gone)
    _delete_all(spark, [f"{path}/event_date={d}/batch_id={b}" for d, b in gone])


def _delete_all(spark: SparkSession, paths: list[str]) -> None:
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(lambda p: delete_path(spark, p), paths))


def lake_writer(df: DataFrame, path: str, checkpoint: str, *, time_col: str,
                trigger: dict | None = None, query_name: str | None = None):
    """K3: exactly-once append of raw rows to a date-partitioned Parquet lake
    table (the file sink commits each batch in its own log)."""
    out = df.withColumn("event_date", F.to_date(F.timestamp_millis(F.col(time_col))))
    w = (out.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint)
            .partitionBy("event_date"))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"processingTime": "60 seconds"}))
    return w.start(path)


def kafka_writer(df: DataFrame, bootstrap: str, topic: str, checkpoint: str, *,
                 key_col: str | None = "symbol", trigger: dict | None = None,
                 options: dict | None = None):
    """Publish rows as JSON to a topic, keyed by ``key_col`` so the broker
    partitions them by symbol (I15, I16). Needs the Kafka module on the
    classpath (absent here, untested)."""
    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    out = df.select(key.alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))
    w = (out.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("topic", topic)
            .option("checkpointLocation", checkpoint))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    return w.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
