"""Bounded samples of labelled documents, and the folds that the contracts fix."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, whole_text
from tidemark.session import materialize


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % folds).cast("int")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int) -> tuple[DataFrame, float]:
    """(doc_id, text, y) of at most ``per_class`` labelled documents of each
    class (0 and 1), the first by a hash of the id, among ids for which ``usable``
    holds. Rows without a label or an id are left out; of repeated label rows the larger
    label counts, of repeated documents the text that sorts first. The second result is
    what a logit fitted on the sample lacks: the log odds of all usable labels less the sample's."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & usable)
             .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    order = F.xxhash64("doc_id")
    picked = [known.where(F.col("y") == y).orderBy(order, "doc_id").limit(per_class) for y in (0, 1)]
    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    shift = 0.0
    if len(n) == 2:
        shift = math.log(n[1] / n[0]) - math.log(min(n[1], per_class) / min(n[0], per_class))
    ids = materialize(picked[0].unionByName(picked[1]), "sampled-ids")
    rows = small_batches(docs).select("doc_id", whole_text().alias("text")).join(ids, "doc_id")
    return materialize(rows.groupBy("doc_id", "y").agg(F.min("text").alias("text")), "sampled-documents"), shift
