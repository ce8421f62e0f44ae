import datetime as dt

from pyspark.sql import functions as F

from barline.operators.candles import daily_candles
from barline.plans.refresh import read_candles, refresh_candles, touched_rows
from barline.session import work_path
from barline.sources.tables import write_table

COLS = ("id long, symbol string, exchange string, timestamp_ms long, open double, high double, "
        "low double, close double, volume double, ingested_at timestamp")
DAY = 86_400_000


def test_late_row_rewrites_only_its_date(spark):
    t = dt.datetime(2024, 1, 3)
    rows = [(i, "A", "x", i * DAY, 1.0 + i, 2.0 + i, 0.5, 1.5 + i, 10.0, t) for i in range(3)]
    raw = spark.createDataFrame(rows, COLS)
    path = work_path(spark, "refresh")
    refresh_candles(raw, path, "day")
    before = {r["date"]: r for r in read_candles(spark, path).collect()}
    late = spark.createDataFrame([(9, "A", "x", 0 * DAY + 1000, 7.0, 9.0, 0.1, 8.0, 5.0,
                                   dt.datetime(2024, 1, 5))], COLS)
    all_raw = raw.unionByName(late)
    refresh_candles(all_raw, path, "day", since=F.lit(dt.datetime(2024, 1, 4)))
    after = read_candles(spark, path)
    full = daily_candles(all_raw)
    assert after.select(*full.columns).exceptAll(full).count() == 0
    got = {r["date"]: r for r in after.collect()}
    day0 = dt.date(1970, 1, 1)
    assert got[day0]["trade_count"] == 2 and got[day0]["close"] == 8.0
    assert got[dt.date(1970, 1, 2)] == before[dt.date(1970, 1, 2)]


def test_partitioned_raw_is_pruned_to_touched_dates(spark):
    t = dt.datetime(2024, 1, 3)
    rows = [(i, "A", "x", i * DAY, 1.0 + i, 2.0 + i, 0.5, 1.5 + i, 10.0, t) for i in range(6)]
    rows.append((9, "A", "x", 2 * DAY + 1000, 7.0, 9.0, 0.1, 8.0, 5.0, dt.datetime(2024, 1, 5)))
    path, table = work_path(spark, "raw-dated"), work_path(spark, "refresh-dated")
    write_table(spark.createDataFrame(rows, COLS).withColumn("d", F.to_date(F.timestamp_millis("timestamp_ms"))),
                path, partition_by=["d"])
    raw = spark.read.parquet(path)
    touched = touched_rows(raw, F.lit(dt.datetime(2024, 1, 4)), "d")
    assert "dynamicpruning" in touched._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["id"] for r in touched.collect()) == [2, 9]
    refresh_candles(raw, table, "day", partition_column="d")
    full = daily_candles(raw.drop("d"))
    assert read_candles(spark, table).select(*full.columns).exceptAll(full).count() == 0
