"""Health that can fail, checks that ride on writes, unique by bitmaps, high-water marks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barline.operators import dedupe as D
from barline.plans import monitoring as MON
from barline.plans import quality as Q
from barline.plans import runlog as RL
from barline.session import stored, work_path

NOW = dt.datetime(2024, 1, 2, 12, 0)


def tables(spark):
    base = work_path(spark, "health")
    paths = {n: f"{base}/{n}" for n in ("raw_ohlcv", "ohlcv_hourly", "ohlcv_daily", "technical_indicators")}
    for i, p in enumerate(paths.values()):
        spark.range(i + 1).write.parquet(p)
    return paths


def runs(spark, status, at):
    start = RL.single_event(spark, "dag", "r1", "running", at, started=True)
    return RL.current_runs(start.unionByName(RL.single_event(spark, "dag", "r1", status, at + dt.timedelta(seconds=1), 3, "boom")))


def test_all_up(spark):
    report = MON.health(spark, tables(spark), runs(spark, "success", NOW), F.lit(NOW))
    assert [(r["component"], r["table_name"], r["row_count"], r["status"]) for r in report.collect()] == [
        ("storage", "raw_ohlcv", 1, "up"), ("storage", "ohlcv_hourly", 2, "up"), ("storage", "ohlcv_daily", 3, "up"),
        ("storage", "technical_indicators", 4, "up"), ("runs", "pipeline_runs", 1, "up"), ("overall", None, None, "up")]
    MON.require_healthy(report)


def test_unreadable_table_is_down(spark):
    paths = tables(spark)
    paths["ohlcv_daily"] += "-gone"
    broken = spark.range(3).withColumn("x", F.raise_error(F.lit("disk error")).cast("int")).filter("x is null")
    report = MON.health(spark, paths | {"technical_indicators": broken})
    got = {r["table_name"]: (r["row_count"], r["status"]) for r in report.collect()}
    assert got == {"raw_ohlcv": (1, "up"), "ohlcv_hourly": (2, "up"), "ohlcv_daily": (None, "down"), "technical_indicators": (None, "down"), None: (None, "down")}
    with pytest.raises(RuntimeError, match="ohlcv_daily"):
        MON.require_healthy(report)
    with pytest.raises(ValueError):
        MON.health(spark, {"secrets": "x"})


@pytest.mark.parametrize("status,ago,down", [("failed", 2, True), ("failed", 10, False), ("success", 2, False)])
def test_failed_run_alerts(spark, status, ago, down):
    states = runs(spark, status, NOW - dt.timedelta(minutes=ago))
    assert Q.failed_runs(states, F.lit(NOW)).first()["passed"] is not down
    report = {r["component"]: r["status"] for r in MON.health(spark, {}, states, F.lit(NOW)).collect()}
    assert report == {"runs": "down" if down else "up", "overall": "down" if down else "up"}


def test_counts_read_no_columns(spark):
    df = spark.read.parquet(tables(spark)["raw_ohlcv"])
    plan = MON.table_counts({"raw_ohlcv": df})._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan and "Window" not in plan


def test_observed_report_equals_queried_report(spark):
    df = stored(spark.createDataFrame([(1, "a", "neutral", 1.0), (1, None, "bogus", -1.0), (2, "b", None, -2.0), (None, None, "neutral", None)],
                                      "id long, symbol string, rsi_signal string, volume double"), "t")
    checks = Q.TableChecks("t", df, not_null=("symbol", "id"), accepted={"rsi_signal": ("neutral",)}, custom={"positive": F.col("volume") < 0})
    seen = Q.observed(checks)
    stored(seen.df.groupBy("symbol").count(), "written")      # the job that the counts ride on
    unique = Q.TableChecks("t", df, unique=("id",))
    want = Q.check_report([checks, unique])
    got = Q.observed_report(spark, [seen], [unique])
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2


@pytest.mark.parametrize("dense", [None, True, False])
def test_unique_by_bitmaps(spark, dense):
    rows = [(i,) for i in range(-100, 100_000)] + [(5,), (5,), (-3,), (0,), (32_768,), (32_769,), (99_999,), (None,), (None,), (2**62,), (2**62,), (-(2**62),)]
    df = spark.createDataFrame(rows, "id long").repartition(4)
    got = {r["id"]: r["n_records"] for r in Q.unique_failures(df, "id", dense).collect()}
    assert got == {5: 3, -3: 2, 0: 2, 32_768: 2, 32_769: 2, 99_999: 2, 2**62: 2}
    assert Q.unique_failures(spark.range(70_000), "id", dense).count() == 0
    assert Q.unique_failures(spark.createDataFrame([], "id long"), "id").count() == 0
    text = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    assert [tuple(r) for r in Q.unique_failures(text, "id", dense).collect()] == [("a", 2)]


def test_bitmaps_shuffle_buckets_not_ids(spark):
    df = stored(spark.range(200_000), "ids")
    plan = Q.repeated_buckets(df, "id")
    assert plan.count() == 0
    assert df.groupBy(F.bitmap_bucket_number("id")).count().count() == 8   # rows that leave each task at most
    text = Q.unique_failures(df, "id", True)._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in text and "left" in text.lower() and "semi" in text.lower()


def test_marks_follow_batches(spark):
    path = work_path(spark, "marks")
    rows = lambda *r: spark.createDataFrame(r, "id long, symbol string, timestamp_ms long")
    assert D.read_marks(spark, path) is None and D.newer_than_marks(rows((1, "A", 5)), None).count() == 1
    D.update_marks(spark, path, rows((1, "A", 5), (2, "B", 7), (3, None, 2)))
    D.update_marks(spark, path, rows((4, "A", 9), (5, "B", 1)))
    D.update_marks(spark, path, rows((4, "A", 9)))            # replay
    marks = D.read_marks(spark, path)
    assert {r["symbol"]: r["last_timestamp_ms"] for r in marks.collect()} == {"A": 9, "B": 7, None: 2}
    batch = rows((6, "A", 9), (7, "A", 10), (8, "B", 8), (9, "C", 0), (10, None, 2), (11, None, 3))
    newer = D.newer_than_marks(batch, marks)
    assert sorted(r["id"] for r in newer.collect()) == [7, 8, 9, 11]
    plan = D.newer_than_marks(batch, marks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "marks" in plan    # nothing but the marks is read


def test_ingest_keeps_marks(spark):
    import json

    from barline.schemas import MESSAGE_ENVELOPE
    from barline.streaming import ingest as ING
    base = work_path(spark, "ingest-marks")
    st, le = ING.staging_table(spark, f"{base}/s"), ING.dead_letter_table(spark, f"{base}/d")
    for off, ms in ((0, 1000), (1, 5000), (2, 3000)):
        body = json.dumps({"symbol": "A", "exchange": "x", "timestamp_ms": ms, "open": 1, "high": 1, "low": 1, "close": 1, "volume": 1}).encode()
        ING.ingest_batch(spark.createDataFrame([(None, body, "t", 0, off, NOW)], MESSAGE_ENVELOPE), st, le, off, marks_path=f"{base}/m")
    assert [tuple(r) for r in D.read_marks(spark, f"{base}/m").collect()] == [("A", 5000)]
