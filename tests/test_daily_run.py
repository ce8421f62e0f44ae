import datetime as dt

import pytest
from pyspark.sql import functions as F

from barline.operators.candles import candles
from barline.plans.daily_run import daily_run
from barline.session import work_path

COLS = ("id long, symbol string, exchange string, timestamp_ms long, open double, high double, "
        "low double, close double, volume double, ingested_at timestamp")


def test_failed_run_is_recorded_and_raised(spark):
    t = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame([(1, "A", "x", 0, 1.0, 1.0, 1.0, 1.0, 1.0, t)], COLS)
    bad = rows.withColumn("close", F.when(F.col("id") == 1, F.raise_error(F.lit("boom " * 500))).otherwise(F.col("close")))
    out = work_path(spark, "run-fail")
    with pytest.raises(Exception):
        daily_run(spark, bad, out, "r-fail", clock=lambda: t)
    events = spark.read.parquet(f"{out}/pipeline_runs").orderBy("status").collect()
    assert [e["status"] for e in events] == ["failed", "running"]
    assert "boom " * 500 in events[0]["error_message"]


def test_microsecond_epoch_makes_a_candle(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, "A", "x", 1704067200000000, 1.0, 1.0, 1.0, 1.0, 1.0, t),
                                (2, "A", "x", 1704067200000001, 2.0, 2.0, 2.0, 3.0, 1.0, t)], COLS)
    out = candles(df, "day")
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    r = out.select(F.col("date").cast("string"), "open", "close", "trade_count").first()
    assert r[0].startswith("+55969") and tuple(r[1:]) == (1.0, 3.0, 2)


def test_empty_input_stops_early(spark):
    empty = spark.createDataFrame([], COLS)
    out = work_path(spark, "run-empty")
    counts = {r["table_name"]: r["row_count"] for r in
              daily_run(spark, empty, out, "r-empty", clock=lambda: dt.datetime(2024, 1, 1)).collect()}
    assert counts == {"pipeline_runs": 1}


def test_timeframe_filter(spark):
    df = spark.createDataFrame([(1, "A", "x", 0, 1.0, 1.0, 1.0, 1.0, 1.0, "1m"),
                                (2, "A", "x", 10, 9.0, 9.0, 9.0, 9.0, 1.0, "1d")],
                               "id long, symbol string, exchange string, timestamp_ms long, open double, "
                               "high double, low double, close double, volume double, timeframe string")
    r = candles(df, "day", timeframe="1m").collect()[0]
    assert r["trade_count"] == 1 and r["close"] == 1.0


def test_failed_checks_fail_the_run_when_asked(spark):
    t = dt.datetime(2024, 1, 1)
    dup = spark.createDataFrame([(1, "A", "x", 0, 1.0, 1.0, 1.0, 1.0, 1.0, t),
                                 (1, "A", "x", 60000, 1.0, 1.0, 1.0, 1.0, 1.0, t)], COLS)
    out = work_path(spark, "run-checks")
    with pytest.raises(RuntimeError, match="checks failed"):
        daily_run(spark, dup, out, "r-checks", clock=lambda: t, fail_on_checks=True)
    events = spark.read.parquet(f"{out}/pipeline_runs").orderBy("status").collect()
    assert events[0]["status"] == "failed" and "1 data-quality checks failed" in events[0]["error_message"]
    ok = work_path(spark, "run-checks-off")
    assert daily_run(spark, dup, ok, "r-ok", clock=lambda: t).count() == 5


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_second_run_leaves_no_stale_rows(spark, mode):
    t = dt.datetime(2024, 3, 1)
    out, before = work_path(spark, "run-twice"), spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        for run, ms in (("r-1", 1704067200000), ("r-2", 1709251200000)):   # one row in January, then one in March
            raw = spark.createDataFrame([(1, "A", "x", ms, 1.0, 1.0, 1.0, 1.0, 1.0, t)], COLS)
            counts = {r["table_name"]: r["row_count"] for r in daily_run(spark, raw, out, run, clock=lambda: t).collect()}
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    ends = spark.read.parquet(f"{out}/pipeline_runs").filter("status = 'success' AND run_id = 'r-2'").collect()
    assert counts["raw_ohlcv"] == 1 and [e["rows_processed"] for e in ends] == [1]
