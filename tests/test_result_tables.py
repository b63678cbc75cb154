"""Result tables: pruned reads of a time range, compaction of closed dates."""

import os
from datetime import datetime

import pytest

from tidemark import schemas
from tidemark.streaming import commits, sinks

TABLE = schemas.VWAP_AGGREGATIONS


def _row(day, symbol, vwap, version):
    start = datetime(2024, 1, day, 10)
    return (symbol, start, datetime(2024, 1, day, 10, 5), vwap, 1.0, 1, "5m", version)


def _write(spark, path, batch_id, rows):
    sinks.write_batch(spark.createDataFrame(rows, TABLE.schema), batch_id, path, TABLE.time)


def _current(spark, path, **kw):
    return sorted((r.window_start.day, r.symbol, r.vwap) for r in sinks.current_rows(spark, path, TABLE, **kw).collect())


def _filled(spark, path):
    _write(spark, path, 0, [_row(1, "A", 1.0, 5), _row(1, "B", 2.0, 5), _row(2, "A", 3.0, 5)])
    _write(spark, path, 1, [_row(1, "A", 9.0, 6), _row(2, "A", 4.0, 5), _row(3, "A", 7.0, 5)])
    _write(spark, path, 2, [_row(1, "A", 8.0, 4), _row(3, "A", 7.5, 4)])


def test_range_read_prunes_dates_and_pushes_both_bounds(spark, tmp_dir):
    _filled(spark, tmp_dir + "/t")
    df = sinks.current_rows(spark, tmp_dir + "/t", TABLE, datetime(2024, 1, 2), datetime(2024, 1, 3))
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x)
    assert "PartitionFilters: [isnotnull(event_date" in scan
    assert "(window_start#" in scan and ">= 2024-01-02" in scan and "< 2024-01-03" in plan
    assert _current(spark, tmp_dir + "/t", start=datetime(2024, 1, 2), end=datetime(2024, 1, 3)) == [(2, "A", 4.0)]


def test_replayed_batch_replaces_itself_over_several_dates(spark, tmp_dir):
    path = tmp_dir + "/t"
    _filled(spark, path)
    _write(spark, path, 1, [_row(1, "A", 9.0, 6), _row(2, "A", 4.0, 5), _row(3, "A", 7.0, 5)])
    assert spark.read.parquet(path).count() == 8


def _folders(path, day):
    return sorted(os.listdir(f"{path}/event_date=2024-01-0{day}"))


def _stored(spark, path):
    return sinks.stored_rows(spark, path, TABLE).count()


def test_compact_merges_closed_dates(spark, tmp_dir):
    path = tmp_dir + "/t"
    _filled(spark, path)
    before = _current(spark, path)
    assert sinks.compact(spark, path, TABLE, "2024-01-03") == ["2024-01-01", "2024-01-02"]
    assert _current(spark, path) == before == [(1, "A", 9.0), (1, "B", 2.0), (2, "A", 4.0), (3, "A", 7.0)]
    assert _stored(spark, path) == 3 + 2  # one row per key of the closed dates; the open date as it was
    sinks.remove_superseded(spark, path)
    assert _folders(path, 1) == _folders(path, 2) == ["batch_id=-1"] and _folders(path, 3) == ["batch_id=1", "batch_id=2"]
    assert spark.read.parquet(path).count() == 5
    assert sinks.compact(spark, path, TABLE, "2024-01-03") == []  # nothing has changed
    assert _current(spark, path) == before and _stored(spark, path) == 5
    # the job goes on, and a late version still wins after compaction
    _write(spark, path, 3, [_row(1, "B", 2.5, 7), _row(4, "A", 1.0, 1)])
    after = [(1, "A", 9.0), (1, "B", 2.5), (2, "A", 4.0), (3, "A", 7.0), (4, "A", 1.0)]
    assert _current(spark, path) == after
    assert sinks.compact(spark, path, TABLE, "2024-01-04") == ["2024-01-01", "2024-01-03"]  # only dates with later batches
    sinks.remove_superseded(spark, path)
    assert _current(spark, path) == after
    assert [_folders(path, d) for d in (1, 2, 3, 4)] == [["batch_id=-2"], ["batch_id=-1"], ["batch_id=-2"], ["batch_id=3"]]


def test_many_batches_become_one_file_per_date(spark, tmp_dir):
    path = tmp_dir + "/t"
    for k in range(12):
        _write(spark, path, k, [_row(1 + k % 2, f"S{k % 5}", float(k), k)])
    before = _current(spark, path)
    sinks.compact(spark, path, TABLE, "2024-01-03")
    sinks.remove_superseded(spark, path)
    assert _current(spark, path) == before and len(before) == 10
    assert all(sum(f.endswith(".parquet") for f in os.listdir(f"{path}/event_date=2024-01-0{d}/batch_id=-1")) == 1 for d in (1, 2))
    assert len([f for f in os.listdir(path + "/_log") if not f.startswith(".")]) == 2  # the last record and the state


@pytest.mark.parametrize("stop_at", ["put_state", "drop_used_records"])
def test_compaction_that_stops_is_repeated(spark, tmp_dir, monkeypatch, stop_at):
    """Before and after the swap readers see the same rows; the next run goes on from there."""
    path = tmp_dir + "/t"
    _filled(spark, path)
    before = _current(spark, path)
    reader = sinks.current_rows(spark, path, TABLE)  # planned before the run

    def stop(*a):
        raise OSError("gone")

    monkeypatch.setattr(commits, stop_at, stop)
    with pytest.raises(OSError):
        sinks.compact(spark, path, TABLE, "2024-01-03")
    monkeypatch.undo()
    assert _current(spark, path) == before
    assert _stored(spark, path) == (8 if stop_at == "put_state" else 5)
    assert sorted((r.window_start.day, r.symbol, r.vwap) for r in reader.collect()) == before
    _write(spark, path, 3, [_row(2, "B", 1.5, 1)])
    after = sorted(before + [(2, "B", 1.5)])
    sinks.compact(spark, path, TABLE, "2024-01-03")
    sinks.remove_superseded(spark, path)
    assert _current(spark, path) == after
    assert spark.read.parquet(path).where("event_date < '2024-01-03'").count() == 4


def test_compaction_reads_the_dates_that_changed(spark, tmp_dir):
    path = tmp_dir + "/t"
    _filled(spark, path)
    sinks.compact(spark, path, TABLE, "2024-01-03")
    _write(spark, path, 3, [_row(2, "A", 0.5, 9)])
    rows = sinks.stored_rows(spark, path, TABLE).where(commits.date_text().isin(["2024-01-02"]))
    assert rows.count() == 2 and len(rows.collect()) == 2
    scan = rows._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == 2  # the generation of that date and its later batch


def test_a_batch_without_a_record_is_not_read(spark, tmp_dir, monkeypatch):
    path = tmp_dir + "/t"
    _filled(spark, path)
    before = _current(spark, path)

    def stop(*a, **k):
        raise OSError("gone")

    monkeypatch.setattr(commits, "commit", stop)
    with pytest.raises(OSError):
        _write(spark, path, 3, [_row(1, "A", 99.0, 99), _row(5, "A", 1.0, 1)])
    monkeypatch.undo()
    assert _current(spark, path) == before
    _write(spark, path, 3, [_row(1, "A", 99.0, 99), _row(5, "A", 1.0, 1)])
    assert (1, "A", 99.0) in _current(spark, path) and (5, "A", 1.0) in _current(spark, path)


def test_rows_without_a_time(spark, tmp_dir):
    path = tmp_dir + "/t"
    _write(spark, path, 0, [("A", None, None, 1.0, 1.0, 1, "5m", 1), _row(1, "A", 2.0, 1)])
    assert sinks.current_rows(spark, path, TABLE).count() == 2
    assert sinks.compact(spark, path, TABLE, "2024-01-02") == ["2024-01-01"]
    assert sinks.current_rows(spark, path, TABLE).count() == 2


def test_several_outputs_are_committed_together(spark, tmp_dir):
    """A crash between the two writes of a batch shows neither output."""
    good, bad = tmp_dir + "/good", tmp_dir + "/bad"
    fail = {"now": False}

    def second(df):
        if fail["now"]:
            raise OSError("gone")
        return df.where("v < 0")

    write = sinks.multi_writer({"good": (lambda df: df.where("v >= 0"), good), "bad": (second, bad)}, root=tmp_dir)
    batches = [spark.createDataFrame([(k,), (-k - 1,)], "v int") for k in range(3)]
    write(batches[0], 0)
    fail["now"] = True
    with pytest.raises(OSError):
        write(batches[1], 1)
    read = lambda p: sorted(r.v for r in commits.committed_rows(spark, tmp_dir, p).collect())
    assert spark.read.parquet(good).count() == 2  # half written
    assert read(good) == [0] and read(bad) == [-1]
    fail["now"] = False
    write(batches[1], 1)
    write(batches[1], 1)  # a replay
    write(batches[2], 2)
    assert read(good) == [0, 1, 2] and read(bad) == [-3, -2, -1]
