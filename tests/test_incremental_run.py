"""The incremental run on the ingest's staging table: touched dates only, equal to a whole recomputation."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from barline.operators.candles import daily_candles, hourly_candles, int_ohlcv_daily
from barline.operators.indicators import compute_all_indicators
from barline.operators.marts import fct_market_daily
from barline.operators.staging import stg_raw_ohlcv
from barline.plans import incremental_run as IR
from barline.schemas import MESSAGE_ENVELOPE
from barline.session import work_path
from barline.streaming import ingest as ING
from barline.streaming.manifest import compact

DAY, T0 = 86_400_000, 1_704_067_200_000
NOW = dt.datetime(2024, 3, 1)


def message(offset, ms, symbol, close, volume=10.0, **over):
    body = {"symbol": symbol, "exchange": "x", "timestamp_ms": ms, "open": 100.0, "high": close + 5, "low": close - 5, "close": close, "volume": volume} | over
    return (None, json.dumps(body).encode(), "raw", 0, offset, NOW)


def close_rows(got, want, keys):
    key = lambda r: tuple(str(r[k]) for k in keys)
    got, want = sorted(got.collect(), key=key), sorted(want.collect(), key=key)
    assert list(map(key, got)) == list(map(key, want)) and got
    for a, b in zip(got, want, strict=True):
        for c in b.__fields__:
            same = a[c] == pytest.approx(b[c], rel=1e-9, abs=1e-9) if isinstance(b[c], float) else a[c] == b[c]
            assert same, (key(a), c, a[c], b[c])


def check_tables(spark, staging, out):
    raw = staging.read().drop("candle_date")
    daily = daily_candles(raw)
    inter, ind = int_ohlcv_daily(stg_raw_ohlcv(raw)), compute_all_indicators(daily)
    read = lambda n: spark.read.parquet(f"{out}/{n}")
    close_rows(read("ohlcv_hourly"), hourly_candles(raw), ("symbol", "hour_start"))
    close_rows(read("ohlcv_daily"), daily, ("symbol", "date"))
    close_rows(read("technical_indicators"), ind, ("symbol", "date"))
    close_rows(read("fct_market_daily"), fct_market_daily(inter, ind), ("symbol", "date"))


def test_runs_follow_the_ingest(spark):
    base = work_path(spark, "incremental")
    out = f"{base}/out"
    staging, letters = ING.staging_table(spark, f"{base}/staging"), ING.dead_letter_table(spark, f"{base}/dlq")
    offset = iter(range(10_000))

    def ingest(days, symbols="AB", per_day=3, shift=0):
        rows = [message(next(offset), T0 + d * DAY + shift + k * 7_200_000, s, 100.0 + (7 * d + 3 * k) % 11) for d in days for s in symbols for k in range(per_day)]
        ING.ingest_batch(spark.createDataFrame(rows, MESSAGE_ENVELOPE), staging, letters, 0)

    ingest(range(0, 40))
    first = IR.incremental_run(spark, staging, out, "r1", clock=lambda: NOW)
    assert len(first.dates) == 40 and first.rows == 240
    check_tables(spark, staging, out)

    ingest(range(40, 42))
    ingest([41], "C")
    second = IR.incremental_run(spark, staging, out, "r2", clock=lambda: NOW)
    assert second.dates == ["2024-02-10", "2024-02-11"]
    assert all("candle_date=2024-02-1" in f for f in second.opened) and len(second.opened) == len(staging.entries(second.dates))
    check_tables(spark, staging, out)

    ingest([35], shift=60_000)                      # late rows
    compact(staging)
    third = IR.incremental_run(spark, staging, out, "r3", clock=lambda: NOW)
    assert third.dates == ["2024-02-05"] and len(third.opened) == 1 and third.rows == 12
    check_tables(spark, staging, out)

    nothing = IR.incremental_run(spark, staging, out, "r4", clock=lambda: NOW)
    assert nothing.dates == [] and nothing.opened == [] and nothing.rows == 0
    got = {r["table_name"]: r["row_count"] for r in nothing.counts.collect()}
    assert got["raw_ohlcv"] == staging.row_count() == 240 + 12 + 3 + 6 and got["pipeline_runs"] == 4 and got["ohlcv_daily"] == 85


def test_failed_run_is_done_again(spark):
    base = work_path(spark, "incremental-fail")
    out = f"{base}/out"
    staging, letters = ING.staging_table(spark, f"{base}/staging"), ING.dead_letter_table(spark, f"{base}/dlq")
    # two rows of one id: the unique check fails
    twice = spark.createDataFrame([message(1, T0, "A", 10.0), message(1, T0 + 60_000, "A", 11.0)], MESSAGE_ENVELOPE)
    ING.ingest_batch(twice, staging, letters, 0)
    with pytest.raises(RuntimeError, match="1 data-quality checks failed"):
        IR.incremental_run(spark, staging, out, "r1", clock=lambda: NOW, fail_on_checks=True)
    health = {(r["component"], r["table_name"]): r for r in IR.run_health(spark, out, F.lit(NOW)).collect()}
    assert health[("runs", "pipeline_runs")]["status"] == "down" and "1 failed runs" in health[("runs", "pipeline_runs")]["error"]
    assert health[("overall", None)]["status"] == "down" and health[("storage", "ohlcv_daily")]["row_count"] == 1
    again = IR.incremental_run(spark, staging, out, "r2", clock=lambda: NOW)
    assert again.dates == ["2024-01-01"]
    report = {(r["check_name"], r["table_name"], r["column_name"]): r["failures"] for r in spark.read.parquet(f"{out}/check_report").collect()}
    assert report[("unique", "stg_raw_ohlcv", "id")] == 1 and sum(report.values()) == 1 and len(report) == 14
    check_tables(spark, staging, out)


def test_later_steps_read_no_raw_files(spark):
    base = work_path(spark, "incremental-plan")
    out = f"{base}/out"
    staging, letters = ING.staging_table(spark, f"{base}/staging"), ING.dead_letter_table(spark, f"{base}/dlq")
    ING.ingest_batch(spark.createDataFrame([message(i, T0 + i * DAY // 3, "A", 10.0 + i) for i in range(9)], MESSAGE_ENVELOPE), staging, letters, 0)
    IR.incremental_run(spark, staging, out, "r1", clock=lambda: NOW)
    from barline.operators.candles import candles_of, merge_states
    state = IR.read_dates(spark, f"{out}/candle_state", "candle_date IN (DATE'2024-01-02')")
    plan = candles_of(merge_states(state))._jdf.queryExecution().executedPlan().toString()
    assert "staging" not in plan and "PartitionFilters: [isnotnull(candle_date" in plan
    assert candles_of(merge_states(state)).count() == 1


def test_panels_scan_stored_tables(spark):
    base = work_path(spark, "panels")
    out = f"{base}/out"
    staging, letters = ING.staging_table(spark, f"{base}/staging"), ING.dead_letter_table(spark, f"{base}/dlq")
    rows = [message(100 * i + k, T0 + i * DAY, s, 10.0 + i) for i in range(95) for k, s in enumerate("AB")]
    ING.ingest_batch(spark.createDataFrame(rows, MESSAGE_ENVELOPE), staging, letters, 0)
    IR.incremental_run(spark, staging, out, "r1", clock=lambda: NOW)
    from barline.plans.monitoring import panels
    shown = panels(spark, out, "A")
    assert {k: df.count() for k, df in shown.items()} == {"closes": 90, "moving_averages": 90, "rsi": 90, "runs": 1}
    assert shown["closes"].first()["close"] == 104.0
    plan = panels(spark, out, "A")["rsi"]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "EqualTo(symbol,A)" in plan


def test_discard_removes_only_stored_folders(spark):
    from barline.session import discard, stored
    kept, gone = stored(spark.range(3), "kept"), stored(spark.range(3), "gone")
    discard(gone)
    discard(spark.range(3))
    assert kept.count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(gone._stored_at).count()
