"""Latest row per key ("highest version wins") over append-only result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, key: Sequence[str], *, version: str = "version",
                  tiebreak: Sequence[str] = ("batch_id", "seq")) -> DataFrame:
    """One row per ``key``: the one with the highest ``version``; ties go to the
    higher ``tiebreak`` columns that exist (later batch, later row), then to
    the remaining columns so the result is deterministic.

    One ``max`` over a struct that holds every other column once, in that
    order: it is combined map-side, so a key with a third of all rows ships one
    partial row per input partition."""
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    ties = [c for c in tiebreak if c in df.columns and c != version]
    ordered = [version, *ties, *(c for c in rest if c != version and c not in ties)]
    out = df.groupBy(*key).agg(F.max(F.struct(*ordered)).alias("_r"))
    return out.select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest])
