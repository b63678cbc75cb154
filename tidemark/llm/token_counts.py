"""Token counts through a digest cache.

The cache is a Parquet table (tokenizer_digest, digest, n_tokens). A text's
content (null: empty; nothing else may be normalised away, as every byte can
change the count) is named by its SHA-256, the tokenizer by the digest of its
file. Stored counts are joined by both digests; only distinct contents that the
cache lacks are encoded, and their counts are appended to it.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokenizer
from tidemark.llm.common import small_batches, whole_text
from tidemark.session import path_exists, scratch_path

CACHE_COLUMNS = "tokenizer_digest string, digest string, n_tokens long"


def _cached(spark, cache_path: str, version: str) -> DataFrame:
    """Digest -> count of one tokenizer version. Two runs that appended the
    same content at once left two equal rows; one is read."""
    if not path_exists(spark, cache_path):
        return spark.createDataFrame([], "digest string, n_tokens long")
    return (spark.read.schema(CACHE_COLUMNS).parquet(cache_path).where(F.col("tokenizer_digest") == version)
            .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))


def fill_cache(docs: DataFrame, tokenizer_path: str, cache_path: str) -> None:
    """Append the counts of the distinct texts of ``docs`` that the cache lacks."""
    spark = docs.sparkSession
    version = tokenizer.file_digest(tokenizer_path)
    texts = small_batches(docs).select(whole_text().alias("content")).withColumn("digest", F.sha2("content", 256))
    if path_exists(spark, cache_path):
        texts = texts.join(_cached(spark, cache_path, version), "digest", "left_anti")
    misses = texts.dropDuplicates(["digest"]).select("digest", "content")

    def encode(batches):
        count = tokenizer.load(tokenizer_path).count
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([count(x.as_py()) for x in b.column(1)], pa.int64())],
                                  names=["digest", "n_tokens"])

    (misses.mapInArrow(encode, "digest string, n_tokens long")
     .select(F.lit(version).alias("tokenizer_digest"), "digest", "n_tokens")
     .write.mode("append").partitionBy("tokenizer_digest").parquet(cache_path))


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str | None = None, limit: int = 512) -> DataFrame:
    """Tokens of every whole text: doc_id, n_bytes, n_tokens, over_limit.

    One row per input row, in any number; null texts count as empty (0 tokens),
    rows with a null doc_id stay, other columns are not read. Without a
    ``cache_path`` the cache is a new one under the shared folder."""
    spark = docs.sparkSession
    cache_path = cache_path or scratch_path(spark, "token-cache")
    fill_cache(docs, tokenizer_path, cache_path)
    rows = docs.select("doc_id", whole_text().alias("content")).select(
        "doc_id", F.octet_length("content").cast("long").alias("n_bytes"), F.sha2("content", 256).alias("digest"))
    counts = _cached(spark, cache_path, tokenizer.file_digest(tokenizer_path))
    return rows.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
