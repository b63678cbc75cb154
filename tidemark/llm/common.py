"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
DEFAULT_ROWS = "10000"
TEXT_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(col: str = "text") -> Column:
    """The text of a document; a null text is an empty one."""
    return F.coalesce(F.col(col), F.lit(""))


def small_batches(df: DataFrame) -> DataFrame:
    """Whole texts are wide rows, so the session hands rows to Python ``TEXT_ROWS`` at
    a time, which bounds a worker's memory; a setting of the user's own stays."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_ROWS) == DEFAULT_ROWS:
        conf.set(BATCH_ROWS, str(TEXT_ROWS))
    return df


def pieces_of(rows: int, per_piece: int) -> int:
    """Number of pieces of at most ``per_piece`` rows, at least one."""
    return max(1, -(-rows // per_piece))
