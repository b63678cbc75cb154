"""Incremental reconciliation over stored tables."""

import os
import random
from datetime import datetime, timezone

import pytest
from conftest import ms
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.reconcile import reconcile_hourly
from tidemark.plans import reconciliation
from tidemark.plans.reconciliation import current_verdicts, refresh_reconciliation
from tidemark.streaming import commits, sinks

HOUR = 3_600_000
T0 = ms("2024-01-01 20:00:00")


class Stores:
    """A lake and a VWAP table written batch by batch, and the rows in them."""

    def __init__(self, spark, root):
        self.spark, self.paths = spark, {k: os.path.join(root, k) for k in ("lake", "vwap", "sums", "out")}
        self.lake, self.windows, self.batches = [], {}, {"lake": 0, "vwap": 0}

    def add_lake(self, rows):
        df = self.spark.createDataFrame([(s, float(p), float(q), t, True, t) for s, t, p, q in rows], schemas.RAW_A)
        sinks.write_batch(df, self.batches["lake"], self.paths["lake"], F.timestamp_millis("trade_time"))
        self.batches["lake"] += 1
        self.lake += rows

    def add_windows(self, rows, version=1):
        at = lambda t: datetime.fromtimestamp(t / 1000, timezone.utc).replace(tzinfo=None)
        df = self.spark.createDataFrame([(s, at(t), at(t + 300_000), float(v), 1.0, 1, "5m", version) for s, t, v in rows], schemas.VWAP_AGGREGATIONS.schema)
        sinks.write_batch(df, self.batches["vwap"], self.paths["vwap"], "window_start")
        self.batches["vwap"] += 1
        self.windows.update({(s, t): float(v) for s, t, v in rows})

    def run(self, now, **kw):
        return refresh_reconciliation(self.spark, lake_raw_a=self.paths["lake"], vwap_results=self.paths["vwap"], sums_path=self.paths["sums"],
                                      out_path=self.paths["out"], now=now, **kw)

    def verdicts(self):
        return {(r.symbol, ms(str(r.window_start))): (round(r.batch_vwap, 9), round(r.streaming_vwap, 9), r.status)
                for r in current_verdicts(self.spark, self.paths["out"]).collect()}

    def expected(self, now):
        """All ended hours compared at once over all rows."""
        lake = self.spark.createDataFrame([(s, float(p), float(q), t) for s, t, p, q in self.lake], "symbol string, price double, quantity double, trade_time long")
        at = lambda t: datetime.fromtimestamp(t / 1000, timezone.utc).replace(tzinfo=None)
        windows = self.spark.createDataFrame([(s, at(t), at(t + 300_000), v, 1.0) for (s, t), v in self.windows.items()],
                                             "symbol string, window_start timestamp, window_end timestamp, vwap double, total_volume double")
        res, _ = reconcile_hourly(lake, windows, run_time=now)
        return {(r.symbol, ms(str(r.window_start))): (round(r.batch_vwap, 9), round(r.streaming_vwap, 9), r.status)
                for r in res.where(F.col("window_end") <= F.lit(now)).collect()}


def _at(hour, minute=5):
    return datetime(2024, 1, 1 + hour // 24, hour % 24, minute)


def test_late_rows_correct_an_earlier_verdict(spark, tmp_dir):
    s = Stores(spark, tmp_dir)
    s.add_lake([("BTCUSDT", T0 + 1000, 100, 1), ("BTCUSDT", T0 + 400_000, 110, 1), ("ETHUSDT", T0 + 1000, 10, 1)])
    s.add_windows([("BTCUSDT", T0, 100), ("BTCUSDT", T0 + 300_000, 120), ("ETHUSDT", T0, 10)])
    first, missing = s.run(_at(21))
    assert {(r.symbol, r.status) for r in first.collect()} == {("BTCUSDT", "ALERT"), ("ETHUSDT", "OK")} and missing.count() == 0
    s.add_lake([("BTCUSDT", T0 + 500_000, 130, 1), ("SOLUSDT", T0 + 500_000, 1, 1)])  # late, of the same hour
    second, missing = s.run(_at(22))
    assert [(r.symbol, r.batch_vwap, r.streaming_vwap, r.status) for r in second.where("symbol = 'BTCUSDT'").collect()] == [
        ("BTCUSDT", 340 / 3, 110.0, "ALERT")]
    assert [(r.symbol, r.reason) for r in missing.collect()] == [("SOLUSDT", "stream")]
    assert s.verdicts() == s.expected(_at(22))
    versions = {r.symbol: r.version for r in current_verdicts(spark, s.paths["out"]).collect()}
    assert versions["BTCUSDT"] == ms("2024-01-01 22:05:00") // 1000
    third, _ = s.run(_at(23))
    assert third.count() == 0  # nothing has changed


def test_hours_wait_until_they_have_ended(spark, tmp_dir):
    s = Stores(spark, tmp_dir)
    s.add_lake([("A", T0 + 1000, 5, 1), ("A", T0 + HOUR + 1000, 6, 1)])
    s.add_windows([("A", T0, 5), ("A", T0 + HOUR, 6)])
    s.run(_at(21, 30))
    assert set(s.verdicts()) == {("A", T0)}
    s.run(_at(22, 0))  # no new rows, but the hour is over
    assert s.verdicts() == s.expected(_at(22, 0)) and len(s.verdicts()) == 2


def test_equal_to_the_whole_after_random_batches(spark, tmp_dir):
    r = random.Random(3)
    s = Stores(spark, tmp_dir)
    hours = 9
    for step in range(5):
        s.add_lake([(r.choice("ABC"), T0 + r.randrange((step + 1) * 2 * HOUR), r.randint(1, 50), r.randint(1, 9)) for _ in range(25)])
        starts = {(r.choice("ABC"), T0 + 300_000 * r.randrange((step + 1) * 24)) for _ in range(15)} - set(s.windows)
        s.add_windows([(x, t, r.randint(1, 50)) for x, t in starts])
        if step == 2:
            sinks.compact(spark, s.paths["vwap"], schemas.VWAP_AGGREGATIONS, "2024-01-02")
            sinks.remove_superseded(spark, s.paths["vwap"])
        now = _at(20 + min(hours, 2 * step + 1))
        s.run(now)
        assert s.verdicts() == s.expected(now), step


@pytest.mark.parametrize("stop_in", ["sums", "out"])
def test_a_run_that_stopped_is_repeated(spark, tmp_dir, monkeypatch, stop_in):
    s = Stores(spark, tmp_dir)
    s.add_lake([("A", T0 + 1000, 5, 1)])
    s.add_windows([("A", T0, 5)])
    commit = commits.commit

    def stop(spark_, root, *a, **k):
        if root == s.paths[stop_in]:
            raise OSError("gone")
        commit(spark_, root, *a, **k)

    monkeypatch.setattr(commits, "commit", stop)
    with pytest.raises(OSError):
        s.run(_at(21))
    monkeypatch.undo()
    s.add_lake([("A", T0 + 2000, 9, 3)])  # meanwhile
    s.run(_at(22))
    assert s.verdicts() == s.expected(_at(22)) == {("A", T0): (8.0, 5.0, "ALERT")}


def test_reads_the_dates_that_changed(spark, tmp_dir, monkeypatch):
    s = Stores(spark, tmp_dir)
    day = 24 * HOUR
    for k in range(4):
        s.add_lake([("A", T0 + k * day, 5, 1)])
        s.add_windows([("A", T0 + k * day, 5)])
    s.run(datetime(2024, 1, 5, 0, 5))
    s.add_lake([("A", T0 + day + 1000, 7, 1)])
    seen = []
    write = sinks.write_batch
    monkeypatch.setattr(reconciliation, "write_batch", lambda df, *a, **k: (seen.append(df), write(df, *a, **k)))
    s.run(datetime(2024, 1, 5, 0, 5))
    seen[0].collect()  # the new sums: one lake file of five
    scans = [p for p in _leaves(seen[0]) if "lake" in p.toString()]
    assert [p.metrics().apply("numFiles").value() for p in scans] == [1]
    assert s.verdicts() == s.expected(datetime(2024, 1, 5, 0, 5))


def _leaves(df):
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.initialPlan()
    found = plan.collectLeaves()
    return [found.apply(i) for i in range(found.size())]
