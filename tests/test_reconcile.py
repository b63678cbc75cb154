from datetime import datetime

from conftest import ms

from tidemark.operators.reconcile import reconcile, reconcile_hourly, streaming_vwap_range


def _hour(spark, batch, stream):
    b = spark.createDataFrame(batch, "symbol string, batch_vwap double")
    s = spark.createDataFrame(stream, "symbol string, streaming_vwap double")
    return reconcile(b, s, run_time="2024-01-01 02:05:00", window_start="2024-01-01 01:00:00",
                     window_end="2024-01-01 02:00:00")


def test_status_thresholds(spark):
    res, miss = _hour(spark, [("A", 100.0), ("B", 100.0), ("C", 100.0), ("D", 0.0), ("E", 5.0)],
                      [("A", 100.0099), ("B", 100.01), ("C", 100.0101), ("D", 1.0), ("F", 5.0)])
    st = {r.symbol: r.status for r in res.collect()}
    assert st == {"A": "OK", "C": "ALERT", "B": st["B"]} and len(st) == 3
    m = {r.symbol: r.reason for r in miss.collect()}
    assert m == {"D": "undefined_diff", "E": "stream", "F": "batch"}
    r = res.first()
    assert r.version == ms("2024-01-01 02:05:00") // 1000


def test_one_sided_range_gives_reasons_and_no_results(spark):
    res, miss = _hour(spark, [("A", 100.0), ("B", 5.0)], [])
    assert res.count() == 0 and {(r.symbol, r.reason) for r in miss.collect()} == {("A", "no_streamed_rows"), ("B", "no_streamed_rows")}
    res, miss = _hour(spark, [], [("A", 100.0)])
    assert res.count() == 0 and [(r.symbol, r.reason) for r in miss.collect()] == [("A", "no_batch_rows")]
    res, miss = _hour(spark, [], [])
    assert res.count() == 0 and miss.count() == 0


def test_outage_of_the_streaming_job_is_reported(spark):
    t = datetime.fromisoformat
    raw = spark.createDataFrame([("A", 30.0, 1.0, ms("2024-01-01 01:10:00")), ("A", 10.0, 1.0, ms("2024-01-01 00:10:00"))],
                                "symbol string, price double, quantity double, trade_time long")
    vw = spark.createDataFrame([("A", t("2024-01-01 00:10:00"), t("2024-01-01 00:15:00"), 10.0, 1.0)],
                               "symbol string, window_start timestamp, window_end timestamp, vwap double, total_volume double")
    res, miss = reconcile_hourly(raw, vw, run_time="2024-01-01 03:00:00")
    assert [r.window_start.hour for r in res.collect()] == [0]
    assert [(r.window_start.hour, r.symbol, r.reason) for r in miss.collect()] == [(1, "A", "no_streamed_rows")]


def test_streaming_range_and_hourly(spark):
    t = datetime.fromisoformat
    vw = spark.createDataFrame([
        ("A", t("2024-01-01 00:55:00"), t("2024-01-01 01:00:00"), 10.0, 1.0),
        ("A", t("2024-01-01 01:00:00"), t("2024-01-01 01:05:00"), 20.0, 1.0),
        ("A", t("2024-01-01 01:55:00"), t("2024-01-01 02:00:00"), 40.0, 3.0),
        ("A", t("2024-01-01 01:58:00"), t("2024-01-01 02:03:00"), 99.0, 1.0)],   # crosses the hour
        "symbol string, window_start timestamp, window_end timestamp, vwap double, total_volume double")
    s = streaming_vwap_range(vw, "2024-01-01 01:00:00", "2024-01-01 02:00:00").first()
    assert s.streaming_vwap == 30.0
    sw = streaming_vwap_range(vw, "2024-01-01 01:00:00", "2024-01-01 02:00:00", weighted=True).first()
    assert sw.streaming_vwap == (20 + 120) / 4
    raw = spark.createDataFrame([("A", 30.0, 1.0, ms("2024-01-01 01:10:00")),
                                 ("A", 10.0, 1.0, ms("2024-01-01 00:10:00"))],
                                "symbol string, price double, quantity double, trade_time long")
    res, miss = reconcile_hourly(raw, vw, run_time="2024-01-01 03:00:00")
    got = {r.window_start.hour: (r.batch_vwap, r.streaming_vwap, r.status) for r in res.collect()}
    assert got == {0: (10.0, 10.0, "OK"), 1: (30.0, 30.0, "OK")}
