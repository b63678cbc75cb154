import os
from datetime import datetime

from conftest import ms
from rows import trades_a, trades_b

from tidemark.sources import feeds, lake
from tidemark.streaming import commits, jobs


def test_create_tables_idempotent_and_bound_read(spark, tmp_dir):
    db = "tidemark_test_db"
    lake.create_database(spark, db, location=os.path.join(tmp_dir, "db"))
    for _ in range(2):                                   # idempotent
        lake.create_lake_tables(spark, db, root=os.path.join(tmp_dir, "lake"))
        lake.create_result_tables(spark, db, root=os.path.join(tmp_dir, "res"))
    tables = {r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect()}
    assert {"binance_trades_raw", "coinbase_trades_raw", "vwap_aggregations", "whale_alerts",
            "arbitrage_signals", "double_bottom_signals", "recon_results"} <= tables
    # columns: the table's own, then the partition columns event_date and batch_id
    spark.sql(f"INSERT INTO {db}.vwap_aggregations VALUES ('BTCUSDT', TIMESTAMP'2024-01-01 16:00:00', "
              f"TIMESTAMP'2024-01-01 16:05:00', 1.0, 1.0, 1, '5m', 1, DATE'2024-01-01', 1)")
    got = lake.read_result_range(spark, f"{db}.vwap_aggregations", datetime(2024, 1, 1, 16), datetime(2024, 1, 1, 17))
    assert got.count() == 1
    assert "PartitionFilters: [isnotnull(event_date" in got._jdf.queryExecution().executedPlan().toString()
    spark.sql(f"INSERT INTO {db}.binance_trades_raw VALUES ('BTCUSDT', 1.0, 2.0, 1704124800000, true, 1704124800005, DATE'2024-01-01', 0)")
    r = lake.read_raw_range(spark, f"{db}.binance_trades_raw", "trade_time", 1704124800000, 1704124800001)
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert r.count() == 1 and "PartitionFilters: [isnotnull(event_date" in plan


ONCE = {"availableNow": True}
T0 = ms("2024-01-01 23:50:00")
HOUR = 3_600_000


def _tables(spark, db, root):
    lake.create_lake_tables(spark, db, root=root)
    lake.create_result_tables(spark, db, root=root)


def test_catalog_tables_show_what_the_jobs_wrote(spark, tmp_dir):
    db, root, src = "tidemark_jobs_db", os.path.join(tmp_dir, "tables"), os.path.join(tmp_dir, "in")
    lake.create_database(spark, db, location=os.path.join(tmp_dir, "db"))
    _tables(spark, db, root)
    trades_b(spark, [("BTC-USD", T0, 9, 100, 1)]).write.parquet(os.path.join(tmp_dir, "b"))
    for k in range(3):  # over midnight, one file per start
        trades_a(spark, [("BTCUSDT", T0 + k * 400_000 + i * 1000, 10 * k + i, 100 + k, 1) for i in range(4)]).coalesce(1).write.mode("append").parquet(src)
        for q in jobs.lake_job(feeds.read_trades_a(spark, src, stream=True), feeds.read_trades_b(spark, os.path.join(tmp_dir, "b"), stream=True), root,
                               checkpoint=os.path.join(tmp_dir, "ck"), trigger=ONCE, catalog=db):
            q.awaitTermination()
        jobs.vwap_job(feeds.read_trades_a(spark, src, stream=True), os.path.join(root, "vwap_aggregations"), checkpoint=os.path.join(tmp_dir, "ckv"),
                      trigger=ONCE, catalog=db).awaitTermination()
    got = lake.read_raw_range(spark, f"{db}.binance_trades_raw", "trade_time", T0, T0 + HOUR)
    assert got.count() == 12 and {str(r.event_date) for r in got.collect()} == {"2024-01-01", "2024-01-02"}
    assert lake.read_raw_range(spark, f"{db}.binance_trades_raw", "trade_time", T0 + 1000, T0 + 400_000).count() == 3
    assert lake.read_raw_range(spark, f"{db}.coinbase_trades_raw", "event_time", T0, T0 + HOUR).count() == 1
    by_path = lake.read_raw_path(spark, os.path.join(root, "binance_trades_raw"), "trade_time", T0, T0 + HOUR)
    assert by_path.count() == 12
    windows = lake.read_result_range(spark, f"{db}.vwap_aggregations", datetime(2024, 1, 1), datetime(2024, 1, 3))
    assert sorted(r.vwap for r in windows.collect()) == [100.0, 101.0]  # the third window is still open
    # a table created later, over batches that are there already
    spark.sql(f"DROP TABLE {db}.binance_trades_raw")
    _tables(spark, db, root)
    assert spark.table(f"{db}.binance_trades_raw").count() == 0
    for _ in range(2):
        lake.add_committed_partitions(spark, f"{db}.binance_trades_raw", os.path.join(root, "binance_trades_raw"))
    assert spark.table(f"{db}.binance_trades_raw").count() == 12


def test_catalog_read_gives_the_current_version(spark, tmp_dir):
    from tidemark import schemas
    from tidemark.streaming import sinks

    db, root = "tidemark_versions_db", os.path.join(tmp_dir, "tables")
    lake.create_database(spark, db, location=os.path.join(tmp_dir, "db"))
    _tables(spark, db, root)
    path, name = os.path.join(root, "vwap_aggregations"), f"{db}.vwap_aggregations"
    start, end = datetime(2024, 1, 1, 16), datetime(2024, 1, 1, 16, 5)

    def write(batch, vwap, version):
        rows = spark.createDataFrame([("BTCUSDT", start, end, vwap, 1.0, 1, "5m", version)], schemas.VWAP_AGGREGATIONS.schema)
        sinks.write_batch(rows, batch, path, "window_start", catalog_table=name)

    def read(**kw):
        return [r.vwap for r in lake.read_result_range(spark, name, datetime(2024, 1, 1), datetime(2024, 1, 2), **kw).collect()]

    write(0, 1.0, 5)
    write(1, 2.0, 7)
    write(2, 3.0, 6)
    write(2, 3.0, 6)  # a replay
    assert read() == [2.0] and sorted(read(all_versions=True)) == [1.0, 2.0, 3.0]
    sinks.compact(spark, path, schemas.VWAP_AGGREGATIONS, "2024-01-02", catalog_table=name)
    assert read() == [2.0]
    sinks.remove_superseded(spark, path, catalog_table=name)
    assert read(all_versions=True) == [2.0]
    assert commits.committed_batch(spark, path) == 2
