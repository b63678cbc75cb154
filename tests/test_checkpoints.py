"""Where intermediate data and checkpoints go."""

import os

import pytest
from conftest import ms
from rows import trades_a, trades_b

from tidemark import session
from tidemark.sources import feeds
from tidemark.streaming import jobs

T0 = ms("2024-01-01 00:00:00")
POLICY = "spark.sql.streaming.multipleWatermarkPolicy"


class _Session:
    """A session without ``spark.checkpoint.dir``."""

    def __init__(self, master):
        self.master, self.folder, self.conf, self.sparkContext = master, None, self, self

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_only_a_local_master_may_leave_the_shared_folder_unset():
    with pytest.raises(RuntimeError):
        session.shared_dir(_Session("spark://somewhere:7077"))
    local = _Session("local[4]")
    assert session.shared_dir(local) == session.shared_dir(local) == local.folder
    given = _Session("yarn")
    given.folder = "hdfs://shared/checkpoints"
    assert session.shared_dir(given) == given.folder


def test_default_checkpoint_resumes_in_another_session(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    trades_b(spark, [("BTC-USD", T0, 99, 100, 1)]).write.parquet(os.path.join(tmp_dir, "b"))
    for batch in (range(3), range(3, 6)):
        trades_a(spark, [("BTCUSDT", T0 + i * 1000, i, 100, 6) for i in batch]).coalesce(1).write.mode("append").parquet(src)
        s = spark.newSession()
        q = jobs.whale_job(feeds.read_trades_a(s, src, stream=True), feeds.read_trades_b(s, os.path.join(tmp_dir, "b"), stream=True),
                           out, trigger={"availableNow": True})
        q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 6 and got.select("event_time").distinct().count() == 6
    # another output of the same job has a checkpoint of its own
    assert jobs._ckpt(got, None, "whales", out) != jobs._ckpt(got, None, "whales", out + "2")


def test_idle_venue_policy_is_not_left_in_the_session(spark, tmp_dir):
    """With "max", one idle venue does not hold the other's watermark back."""
    pa, pb = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    trades_a(spark, [("BTCUSDT", T0, 1, 100, 1)]).write.parquet(pa)
    trades_b(spark, [("BTC-USD", T0, 1, 90, 1)]).write.parquet(pb)
    before = spark.conf.get(POLICY, None)
    q = jobs.arbitrage_job(feeds.read_trades_a(spark, pa, stream=True), feeds.read_trades_b(spark, pb, stream=True), os.path.join(tmp_dir, "out"),
                           checkpoint=os.path.join(tmp_dir, "ck"), watermark_policy="max", trigger={"availableNow": True})
    q.awaitTermination()
    assert spark.conf.get(POLICY, None) == before
    assert spark.read.parquet(os.path.join(tmp_dir, "out")).count() == 1
    with open(os.path.join(tmp_dir, "ck", "offsets", "0")) as f:
        assert '"spark.sql.streaming.multipleWatermarkPolicy":"max"' in f.read()
