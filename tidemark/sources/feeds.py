"""Trade feed readers (S1-S5), for streams and batch alike.

Three kinds of input:

* ``typed``: files (Parquet/JSON/...) already holding ``trades_a`` /
  ``trades_b`` rows, read with the declared schema (no inference);
* ``raw``: message text, one JSON per row (``value``) plus its arrival time
  (``received_at``), to be parsed by ``operators.ingest``;
* ``kafka``: a topic; the value is either JSON text (``decode="json"``) or
  registry-framed Avro (``decode="avro"``: a 5-byte frame header, then the
  record). Kafka and Avro need their Spark modules on the classpath; they are
  not part of this environment and are untested here.

``columns`` narrows the schema to what a job reads (S3); Parquet then reads
only those columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas


def _narrow(schema: T.StructType, columns: Sequence[str] | None) -> T.StructType:
    if not columns:
        return schema
    keep = set(columns)
    return T.StructType([f for f in schema.fields if f.name in keep])


def read_typed(spark: SparkSession, path: str, schema: T.StructType, *, stream: bool = False,
               fmt: str = "parquet", columns: Sequence[str] | None = None,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Typed trade rows from files."""
    sch = _narrow(schema, columns)
    if stream:
        r = spark.readStream.format(fmt).schema(sch)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.load(path)
    return spark.read.format(fmt).schema(sch).load(path)


def read_trades_a(spark, path, **kw) -> DataFrame:
    return read_typed(spark, path, schemas.TRADES_A, **kw)


def read_trades_b(spark, path, **kw) -> DataFrame:
    return read_typed(spark, path, schemas.TRADES_B, **kw)


def read_raw(spark: SparkSession, path: str, *, stream: bool = False, fmt: str = "parquet",
             max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw message files with ``value`` and ``received_at``."""
    return read_typed(spark, path, schemas.RAW_MESSAGES, stream=stream, fmt=fmt,
                      max_files_per_trigger=max_files_per_trigger)


def avro_body(value: Column, schema_id: int | None = None) -> Column:
    """The Avro record of a registry frame: a zero byte, a big-endian 4-byte
    schema id, the record. With ``schema_id``, a frame of another writer schema is an
    error instead of being decoded with the wrong one; null stays null."""
    body = F.substring(value, F.lit(6), F.length(value) - 5)
    framed = F.hex(F.substring(value, F.lit(1), F.lit(1))) == "00"
    if schema_id is not None:
        framed = framed & (F.conv(F.hex(F.substring(value, F.lit(2), F.lit(4))), 16, 10).cast("long") == schema_id)
    wrong = F.raise_error(F.concat(F.lit("not a frame of the given schema: "), F.hex(F.substring(value, F.lit(1), F.lit(5)))))
    return F.when(value.isNull(), F.lit(None)).when(framed, body).otherwise(wrong.cast("binary"))


def read_kafka(spark: SparkSession, bootstrap: str, topic: str, *, stream: bool = True,
               starting_offsets: str = "latest", decode: str = "json",
               avro_schema: str | None = None, avro_schema_id: int | None = None, options: dict | None = None) -> DataFrame:
    """S1/S2/S4/S5 from a Kafka topic. ``starting_offsets="latest"`` matches a
    job that only sees messages after its first start; the checkpoint then
    keeps the position (it replaces a consumer group).

    ``decode="json"`` returns ``value`` (text) and ``received_at`` (broker
    timestamp, ms) for ``operators.ingest``; ``decode="avro"`` returns the
    decoded record's columns (``avro_schema_id``: the registry's id of
    ``avro_schema``, checked on every frame)."""
    r = spark.readStream if stream else spark.read
    r = (r.format("kafka").option("kafka.bootstrap.servers", bootstrap)
          .option("subscribe", topic).option("startingOffsets", starting_offsets))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    df = r.load()
    if decode == "json":
        return df.select(F.col("value").cast("string").alias("value"),
                         F.unix_millis("timestamp").alias("received_at"))
    if decode == "avro":
        from pyspark.sql.avro.functions import from_avro  # needs the spark-avro module
        if not avro_schema:
            raise ValueError("decode='avro' needs avro_schema (the record's JSON schema)")
        return df.select(from_avro(avro_body(F.col("value"), avro_schema_id), avro_schema).alias("r")).select("r.*")
    raise ValueError(f"unknown decode {decode!r}")
