import datetime as dt

import pytest
from pyspark.sql import functions as F

from barline.operators import dedupe as D
from barline.plans import monitoring as MON
from barline.plans import quality as Q
from barline.plans import runlog as RL

COLS = "id long, symbol string, exchange string, timestamp_ms long, close double"


def test_insert_ten_then_duplicate(spark):
    ten = spark.createDataFrame([(i, "A", "x", 1800000000000 + i * 60000, 1.0) for i in range(10)], COLS)
    assert D.new_rows(ten, None).count() == 10
    dup = spark.createDataFrame([(1, "A", "x", 5, 1.0), (2, "A", "x", 5, 2.0)], COLS)
    rows = D.new_rows(dup, None).collect()
    assert len(rows) == 1 and rows[0]["id"] == 1
    assert D.new_rows(ten, ten).count() == 0


def test_newer_than_last_and_high_water(spark):
    tgt = spark.createDataFrame([(1, "A", "x", 100, 1.0)], COLS)
    batch = spark.createDataFrame([(2, "A", "x", 100, 1.0), (3, "A", "x", 101, 1.0),
                                   (4, "B", "x", 1, 1.0)], COLS)
    assert sorted(r["id"] for r in D.newer_than_last(batch, tgt).collect()) == [3, 4]
    assert D.high_water_mark(tgt, "NOPE").collect()[0]["last_timestamp_ms"] is None


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a", "neutral"), (1, None, "bogus"), (2, "b", None)],
                               "id long, symbol string, rsi_signal string")
    assert Q.not_null_failures(df, "symbol").count() == 1
    assert Q.unique_failures(df, "id").collect()[0]["id"] == 1
    assert Q.accepted_values_failures(df, "rsi_signal", ["neutral"]).count() == 1  # NULL passes
    rep = Q.check_report([Q.TableChecks("t", df, not_null=("symbol",), unique=("id",),
                                        accepted={"rsi_signal": ("neutral",)})])
    got = {(r["check_name"], r["column_name"]): r["failures"] for r in rep.collect()}
    assert got == {("not_null", "symbol"): 1, ("unique", "id"): 1, ("accepted_values", "rsi_signal"): 1}
    assert Q.run_passed(rep).collect()[0]["all_passed"] is False


def test_table_counts_allow_list(spark):
    with pytest.raises(ValueError):
        MON.table_counts({"secrets": spark.range(1)})


def test_run_log_start_and_failure(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 1)
    start = RL.single_event(spark, "dag", "r1", "running", t0, started=True)
    assert RL.current_runs(start).collect()[0]["status"] == "running"
    end = RL.single_event(spark, "dag", "r1", "failed", t1, 0, "boom")
    r = RL.current_runs(start.unionByName(end)).collect()[0]
    assert (r["status"], r["error_message"], r["started_at"], r["finished_at"]) == ("failed", "boom", t0, t1)


def test_latest_runs_status_code(spark):
    ev = spark.createDataFrame([("r1", "success", dt.datetime(2024, 1, 1)),
                                ("r2", "running", dt.datetime(2024, 1, 2)),
                                ("r3", "failed", dt.datetime(2024, 1, 3))],
                               "run_id string, status string, started_at timestamp")
    got = [(r["run_id"], r["status"]) for r in MON.latest_runs(ev, 2).collect()]
    assert got == [("r3", 0.0), ("r2", 0.5)]
