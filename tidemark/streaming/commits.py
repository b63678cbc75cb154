"""Commit records of the tables that jobs write batch by batch.

A batch counts once its record exists: ``<root>/_log/batch-<id>.json``, one small file written in
one step after all rows of all outputs of the batch. It names the dates that each output got.
Batches of a job follow one another, so readers need the greatest recorded id only: a
batch without a record is the last one, half written, and a replay replaces its rows.

Compaction puts the rows of a date together in one folder, a generation. Which generation of a date is
current is told by the newest ``<root>/_log/state-<n>.json``, which is also written in one step:
before it readers see the old folders, after it the new one.

Spark's readers skip ``_log`` when they list a table by its path.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import delete_path, folder_names, put_text, read_text

NO_DATE = "__HIVE_DEFAULT_PARTITION__"  # the folder of rows without a time
_RECORD = "batch long, outputs map<string, array<string>>, inputs map<string, long>"


def _log(root: str) -> str:
    return f"{root}/_log"


def _ids(spark: SparkSession, root: str, kind: str) -> list[int]:
    names = folder_names(spark, _log(root))
    return sorted(int(n[len(kind) + 1:-5]) for n in names if n.startswith(f"{kind}-") and n.endswith(".json"))


def commit(spark: SparkSession, root: str, batch_id: int, outputs: dict[str, Iterable[str]], inputs: dict[str, int] | None = None) -> None:
    """Write the record of a batch: dates by output, and how far it has read its inputs. A
    replayed batch finds its record and leaves it."""
    record = {"batch": int(batch_id), "outputs": {k: sorted(v) for k, v in outputs.items()}, "inputs": inputs or {}}
    put_text(spark, f"{_log(root)}/batch-{int(batch_id):020d}.json", json.dumps(record))


def state(spark: SparkSession, root: str) -> dict:
    """The newest state: generation, and per compacted date its generation and the last
    batch that is in it."""
    ids = _ids(spark, root, "state")
    return json.loads(read_text(spark, f"{_log(root)}/state-{ids[-1]:020d}.json")) if ids else {"generation": 0, "dates": {}, "superseded": {}}


def put_state(spark: SparkSession, root: str, new: dict) -> None:
    put_text(spark, f"{_log(root)}/state-{new['generation']:020d}.json", json.dumps(new))


def committed_batch(spark: SparkSession, root: str) -> int | None:
    """The last batch that counts, -1 before the first; None for a table without records."""
    batches = _ids(spark, root, "batch")
    if batches:
        return batches[-1]
    covered = [covers for _, covers in state(spark, root)["dates"].values()]
    return max(covered) if covered else None if not folder_names(spark, _log(root)) else -1


def last_record(spark: SparkSession, root: str) -> dict | None:
    batches = _ids(spark, root, "batch")
    return json.loads(read_text(spark, f"{_log(root)}/batch-{batches[-1]:020d}.json")) if batches else None


def records(spark: SparkSession, root: str) -> DataFrame:
    """(batch, output, date) of the records that compaction has not used up yet. They are
    read by Spark: there may be one for each batch of many days."""
    rows = spark.read.schema(_RECORD).option("pathGlobFilter", "batch-*.json").json(_log(root))
    return rows.select("batch", F.explode("outputs").alias("output", "dates")).select("batch", "output", F.explode("dates").alias("date"))


def changed_dates(spark: SparkSession, root: str, output: str, after: int, upto: int) -> list[str]:
    """Dates that got rows of the output in the batches ``after < id <= upto`` (one entry per date;
    dates whose records are used up by a compaction of later batches are named, too)."""
    if not _ids(spark, root, "batch"):
        found = set()
    else:
        rows = records(spark, root).where((F.col("batch") > after) & (F.col("batch") <= upto) & (F.col("output") == output))
        found = {r["date"] for r in rows.select("date").distinct().collect()}
    return sorted(found | {d for d, (_, covers) in state(spark, root)["dates"].items() if covers > after})


def date_text() -> Column:
    return F.coalesce(F.col("event_date").cast("string"), F.lit(NO_DATE))


def date_texts() -> Column:
    """Aggregate: the ``date_text`` of all rows, each once. Dates become text once per date, not per row."""
    undated = F.when(F.count_if(F.col("event_date").isNull()) > 0, F.array(F.lit(NO_DATE))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.transform(F.collect_set("event_date"), lambda d: d.cast("string")), undated)


def visible(spark: SparkSession, root: str, upto: int | None = None) -> Column:
    """Condition on the partition columns (event_date, batch_id) of the rows that count: those of
    recorded batches and, for compacted dates, the current generation and batches after it.
    Spark evaluates it when it lists partitions, so other folders are not opened."""
    last = committed_batch(spark, root)
    if last is None:
        return F.lit(True)
    if upto is not None:
        last = min(last, upto)
    recorded = (F.col("batch_id") >= 0) & (F.col("batch_id") <= last)
    by_run: dict[tuple[int, int], list[str]] = {}
    for date, (generation, covers) in state(spark, root)["dates"].items():
        by_run.setdefault((generation, covers), []).append(date)
    out = None
    for (generation, covers), dates in sorted(by_run.items()):
        current = (F.col("batch_id") == -generation) | (recorded & (F.col("batch_id") > covers))
        out = (F.when if out is None else out.when)(date_text().isin(dates), current)
    return recorded if out is None else out.otherwise(recorded)


def committed_rows(spark: SparkSession, root: str, path: str) -> DataFrame:
    """Rows of one of several outputs whose batches are recorded together under ``root``."""
    last = committed_batch(spark, root)
    rows = spark.read.parquet(path)
    return rows if last is None else rows.where(F.col("batch_id") <= last)


def drop_used_records(spark: SparkSession, root: str) -> None:
    """Remove records of batches whose dates are all compacted, but for the last one, which
    tells how far the table goes, and states before the newest."""
    ids = _ids(spark, root, "batch")
    if len(ids) > 1:
        covered = state(spark, root)["dates"]
        used = F.lit(False)
        by_covers: dict[int, list[str]] = {}
        for date, (_, covers) in covered.items():
            by_covers.setdefault(covers, []).append(date)
        for covers, dates in by_covers.items():
            used = used | (F.col("date").isin(dates) & (F.col("batch") <= covers))
        open_ = {r["batch"] for r in records(spark, root).where(~used).select("batch").distinct().collect()}
        for i in ids[:-1]:
            if i not in open_:
                delete_path(spark, f"{_log(root)}/batch-{i:020d}.json")
    for i in _ids(spark, root, "state")[:-1]:
        delete_path(spark, f"{_log(root)}/state-{i:020d}.json")


def _partition(date: str, batch_id: int) -> str:
    return f"PARTITION (event_date={'null' if date == NO_DATE else f'DATE{date!r}'}, batch_id={batch_id})"


def register(spark: SparkSession, table: str, dates: Iterable[str], batch_id: int) -> None:
    """Add the partitions of a batch to the catalog table at the same location."""
    parts = " ".join(_partition(d, batch_id) for d in sorted(dates))
    if parts:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")


def unregister(spark: SparkSession, table: str, folders: Iterable[tuple[str, int]]) -> None:
    parts = ", ".join(_partition(d, b) for d, b in sorted(folders))
    if parts:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
