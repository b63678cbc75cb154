"""What the stateful jobs keep and what they dropped as late, read back from their checkpoints.

Spark's state data source reads the state store of a stopped or running query as a table, partition by
partition; nothing is gathered but the aggregate asked for. ``expired_windows`` and
``expired_join_rows`` give the rows that the watermark should have removed: none in a sound job.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.session import folder_names, read_text
from tidemark.streaming.sinks import write_batch


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(operatorId, operatorName, stateStoreName, numPartitions, ...) of a checkpoint."""
    return spark.read.format("state-metadata").load(checkpoint)


def watermark_ms(spark: SparkSession, checkpoint: str) -> int:
    """The watermark under which the last finished batch ran: rows and state before it were dropped."""
    done = max(int(n) for n in folder_names(spark, f"{checkpoint}/commits") if n.isdigit())
    return int(json.loads(read_text(spark, f"{checkpoint}/offsets/{done}").splitlines()[1])["batchWatermarkMs"])


def window_state(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """(symbol, window_start, window_end, partition_id) of every open window of the VWAP job."""
    rows = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    return rows.select(F.col("key.symbol").alias("symbol"), F.col("key.window.start").alias("window_start"),
                       F.col("key.window.end").alias("window_end"), "partition_id")


def join_state(spark: SparkSession, checkpoint: str, side: str, operator: int = 0) -> DataFrame:
    """The buffered rows of one side (``left``: venue A, ``right``: venue B) of the interval join."""
    rows = spark.read.format("statestore").option("operatorId", operator).option("joinSide", side).load(checkpoint)
    return rows.select("value.*", "partition_id")


def expired_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Open windows that end at or before the watermark."""
    return window_state(spark, checkpoint).where(F.unix_millis("window_end") <= watermark_ms(spark, checkpoint))


def expired_join_rows(spark: SparkSession, checkpoint: str, half_width_ms: int) -> DataFrame:
    """(side, time_ms) of buffered rows that no row at or after the watermark can join. State is cut to whole
    milliseconds, so a row exactly on the edge may stay one batch longer."""
    wm = watermark_ms(spark, checkpoint)
    sides = [join_state(spark, checkpoint, side).select(F.lit(side).alias("side"), F.unix_millis(col).alias("time_ms"))
             for side, col in (("left", "a_time"), ("right", "b_time"))]
    return sides[0].unionByName(sides[1]).where(F.col("time_ms") < wm - half_width_ms - 1)


_FILE_ENTRY = "path string, timestamp long, batchId long"


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """(name, line) of the small log files of a folder."""
    return spark.read.text(folder).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("name"), F.col("value").alias("line"))


def _file(path: Column) -> Column:
    """A file's name in one form: the log writes file:///a for what a scan names file:/a."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def batch_files(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """(batch, file, watermark_ms) of a query over a file source: the files of each batch, and the
    watermark under which the batch ran. Both logs are read by Spark; there is a line per file."""
    offsets = _lines(spark, f"{checkpoint}/offsets").where(F.col("name").rlike("^[0-9]+$") & (F.col("line") != "v1"))
    batches = offsets.groupBy(F.col("name").cast("long").alias("batch")).agg(
        F.max(F.get_json_object("line", "$.batchWatermarkMs")).cast("long").alias("watermark_ms"),
        # lines of offsets stand in the order of the sources, after the batch's own line; a dash is a source without data so far
        F.max(F.get_json_object("line", "$.logOffset")).cast("long").alias("upto"))
    before = F.coalesce(F.lag("upto").over(Window.orderBy("batch")), F.lit(-1))  # a row per batch
    batches = batches.withColumn("after", before).where("upto > after").select(
        "batch", "watermark_ms", F.explode(F.sequence(F.col("after") + 1, F.col("upto"))).alias("offset"))
    files = (_lines(spark, f"{checkpoint}/sources/{source}").where(F.col("line").startswith("{"))
             .select(F.from_json("line", _FILE_ENTRY).alias("f")).select(_file(F.col("f.path")).alias("file"), F.col("f.batchId").alias("offset")).distinct())
    return files.join(batches, "offset").select("batch", "file", "watermark_ms")


def late_rows(spark: SparkSession, checkpoint: str, trades: DataFrame, *, window: str = C.VWAP_WINDOW, time_col: str = "trade_time") -> DataFrame:
    """R2: (batch, symbol, window_start, window_end, rows) of the rows that the VWAP job dropped as late: those whose
    window had ended under the watermark of the batch that read them. ``trades``: the batch view of the job's only input,
    read by ``feeds.read_trades_a`` from the same folder (one file source; files are matched by name)."""
    at = batch_files(spark, checkpoint)
    rows = trades.select("symbol", F.window(F.timestamp_millis(time_col), window).alias("w"), _file(F.col("_metadata.file_path")).alias("file"))
    partly = rows.groupBy("file", "symbol", "w").agg(F.count("*").alias("rows"))
    return (partly.join(at, "file").where(F.unix_millis("w.end") <= F.col("watermark_ms"))
            .groupBy("batch", "symbol", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")).agg(F.sum("rows").alias("rows")))


def record_late_rows(spark: SparkSession, checkpoint: str, trades: DataFrame, path: str, **kw) -> None:
    """Write the late rows of a job as a table, by the date of their window; a later call replaces what an earlier one wrote."""
    write_batch(late_rows(spark, checkpoint, trades, **kw), 0, path, "window_start")
