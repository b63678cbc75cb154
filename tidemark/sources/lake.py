"""Lake tables (raw trades) and result tables: projections, creation, reads.

Tables are plain Parquet tables in the session catalog, partitioned by event date and
batch so that time-range reads prune whole folders on top of the Parquet
row-group filters. The streaming jobs write them by path and add each batch's
partitions to the catalog when it is committed; ``add_committed_partitions`` does so for
batches that were written before the table was created.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.columns import as_double
from tidemark.operators.latest import latest_by_key
from tidemark.streaming import commits

LAKE_DB = "crypto"
RAW_A_TABLE = "binance_trades_raw"
RAW_B_TABLE = "coinbase_trades_raw"


def raw_a_projection(trades_a: DataFrame) -> DataFrame:
    """Venue A trades -> lake row (6 columns, doubles), X15."""
    return trades_a.select(
        "symbol", as_double("price").alias("price"), as_double("quantity").alias("quantity"),
        "trade_time", "is_buyer_maker", "ingestion_time")


def raw_b_projection(trades_b: DataFrame) -> DataFrame:
    """Venue B trades -> lake row (7 columns, doubles), X15."""
    return trades_b.select(
        "trade_id", "product_id", as_double("price").alias("price"), as_double("size").alias("size"),
        "side", "event_time", "ingestion_time")


def with_event_date(df: DataFrame, time_col: str) -> DataFrame:
    return df.withColumn("event_date", F.to_date(F.timestamp_millis(F.col(time_col))))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_database(spark: SparkSession, db: str = LAKE_DB, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS``."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")


def create_lake_tables(spark: SparkSession, db: str = LAKE_DB, root: str | None = None) -> None:
    """Idempotent creation of the two raw lake tables."""
    create_database(spark, db)
    for name, schema in ((RAW_A_TABLE, schemas.RAW_A), (RAW_B_TABLE, schemas.RAW_B)):
        loc = f" LOCATION '{root}/{name}'" if root else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{name} ({_ddl(schema)}, event_date date, batch_id bigint) "
                  f"USING parquet PARTITIONED BY (event_date, batch_id){loc}")


def create_result_tables(spark: SparkSession, db: str = LAKE_DB, root: str | None = None) -> None:
    """Idempotent creation of the keyed result tables (append form: each
    row also carries ``batch_id`` for the latest-by-key view and its date)."""
    create_database(spark, db)
    for t in schemas.RESULT_TABLES.values():
        loc = f" LOCATION '{root}/{t.name}'" if root else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{t.name} ({_ddl(t.schema)}, event_date date, batch_id bigint) "
                  f"USING parquet PARTITIONED BY (event_date, batch_id){loc}")


def add_committed_partitions(spark: SparkSession, table: str, path: str) -> None:
    """Add the partitions of all committed batches at ``path`` to the catalog table. Safe to repeat."""
    found = spark.read.parquet(path).where(commits.visible(spark, path)).select(commits.date_text().alias("date"), "batch_id").distinct()
    by_batch: dict[int, list[str]] = {}
    for r in found.collect():  # one entry per partition
        by_batch.setdefault(r["batch_id"], []).append(r["date"])
    for batch_id, dates in by_batch.items():
        commits.register(spark, table, dates, batch_id)


def raw_range(rows: DataFrame, time_col: str, start_ms: int, end_ms: int) -> DataFrame:
    """X10 over lake rows: ``start <= time < end``; the date predicate
    prunes partitions, the time predicate is pushed into the Parquet scan."""
    d0 = F.to_date(F.timestamp_millis(F.lit(start_ms)))
    d1 = F.to_date(F.timestamp_millis(F.lit(end_ms)))
    return (rows.where((F.col("event_date") >= d0) & (F.col("event_date") <= d1))
                .where((F.col(time_col) >= start_ms) & (F.col(time_col) < end_ms)))


def read_raw_range(spark: SparkSession, table: str, time_col: str, start_ms: int, end_ms: int) -> DataFrame:
    """S6 + X10: rows of a raw lake table of the catalog."""
    return raw_range(spark.table(table), time_col, start_ms, end_ms)


def read_raw_path(spark: SparkSession, path: str, time_col: str, start_ms: int, end_ms: int) -> DataFrame:
    """S6 + X10: rows of committed batches of a raw lake table at a path."""
    return raw_range(spark.read.parquet(path), time_col, start_ms, end_ms).where(commits.visible(spark, path))


def read_result_range(spark: SparkSession, table: str, start, end, *, all_versions: bool = False) -> DataFrame:
    """The current rows (or all versions) of a VWAP table with windows in a time range, with bound
    parameters (no text splicing)."""
    rows = spark.sql(
        f"SELECT * FROM {table} WHERE event_date >= to_date(:start) AND event_date <= to_date(:end) "
        "AND window_start >= :start AND window_end <= :end",
        args={"start": start, "end": end})
    known = schemas.RESULT_TABLES.get(table.rpartition(".")[2])
    return rows if all_versions or known is None else latest_by_key(rows, known.key, version=known.version, tiebreak=("batch_id",))
