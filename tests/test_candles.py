import datetime as dt

import pytest
from pyspark.sql import functions as F

from barline.operators import candles as C
from barline.operators.staging import stg_raw_ohlcv


def test_hourly_three_candles(three_candles):
    rows = C.hourly_candles(three_candles).orderBy("hour_start").collect()
    assert [r["hour_start"] for r in rows] == [dt.datetime(2023, 6, 15, 9, 0), dt.datetime(2023, 6, 15, 11, 0)]
    one = rows[0]
    assert (one["open"], one["high"], one["low"], one["close"]) == (8.0, 9.5, 7.25, 7.5)
    assert (one["volume"], one["trade_count"]) == (16.0, 2)
    assert one["vwap"] == pytest.approx((9.0 * 12 + 7.5 * 4) / 16)


def test_daily_three_candles(three_candles):
    r, = C.daily_candles(three_candles).collect()
    assert (r["open"], r["close"], r["volume"], r["trade_count"]) == (8.0, 7.0, 21.0, 3)
    assert r["date"] == dt.date(2023, 6, 15)


def test_order_without_id_column(three_candles):
    r, = C.daily_candles(three_candles.drop("id")).collect()
    assert r["open"] == 8.0


def test_zero_volume_gives_null_vwap(spark):
    df = spark.createDataFrame([(1, "X", "e", 0, 1.0, 1.0, 1.0, 1.0, 0.0)],
                               "id long, symbol string, exchange string, timestamp_ms long, open double, "
                               "high double, low double, close double, volume double")
    assert C.hourly_candles(df).collect()[0]["vwap"] is None


def test_ties_on_timestamp_break_by_id(spark):
    df = spark.createDataFrame([(2, "X", "e", 0, 2.0, 2.0, 2.0, 20.0, 1.0),
                                (1, "X", "e", 0, 1.0, 1.0, 1.0, 10.0, 1.0)],
                               "id long, symbol string, exchange string, timestamp_ms long, open double, "
                               "high double, low double, close double, volume double")
    r = C.hourly_candles(df).collect()[0]
    assert (r["open"], r["close"]) == (1.0, 20.0)


def test_rank_join_form_agrees(three_candles):
    a = C.hourly_candles(three_candles)
    b = C.candles_rank_join(three_candles, "hour")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_min_by_plan_has_one_exchange_and_no_sort(three_candles):
    plan = C.hourly_candles(three_candles)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Window" not in plan


def test_int_daily_and_return(three_candles):
    staged = stg_raw_ohlcv(three_candles.withColumn("ingested_at", F.current_timestamp()))
    r = C.int_ohlcv_daily(staged).collect()[0]
    assert r["candle_count"] == 3
    assert r["daily_return"] == pytest.approx(7.0 / 8.0 - 1)


def test_first_last_rows(three_candles):
    first = C.first_last_rows(three_candles, ["symbol"], ["timestamp_ms", "id"], "first").collect()[0]
    last = C.first_last_rows(three_candles, ["symbol"], ["timestamp_ms", "id"], "last").collect()[0]
    assert first["id"] == 31 and last["id"] == 33


def test_hash_aggregate_plan(three_candles):
    plan = C.hourly_candles(three_candles)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_packed_order_key_orders_like_struct(spark):
    import random
    rnd = random.Random(3)
    rows = [(86_400_000 * 10 ** 9 + rnd.randint(0, 86_399_999), rnd.choice([-2 ** 63, 2 ** 63 - 1, rnd.randint(-9, 9)]))
            for _ in range(300)]
    df = spark.createDataFrame(rows, "timestamp_ms long, id long")
    k = df.select("timestamp_ms", "id", C.order_key(df, ["timestamp_ms", "id"], in_day=True).alias("k"))
    assert "decimal" in k.schema["k"].dataType.simpleString()
    got = [(r[0], r[1]) for r in k.orderBy("k").collect()]
    assert got == sorted(rows)


def test_data_beyond_declared_widths_take_the_struct_key(spark):
    rows = [(2 ** 50, 1, 4), (2 ** 50, -7, 4), (3, 2 ** 60, 4)]
    df = spark.createDataFrame(rows, "timestamp_ms long, id long, line long")
    bits = {"timestamp_ms": 44, "id": 40, "line": 8}
    order = ["timestamp_ms", "id", "line"]
    wide = df.select("*", C.order_key(df, order, bits).alias("k"))
    assert wide.schema["k"].dataType.typeName() == "struct"
    assert [tuple(r)[:3] for r in wide.orderBy("k").collect()] == sorted(rows)
    fits = df.filter("id < 100 AND timestamp_ms < 100").union(spark.createDataFrame([(5, None, 4)], df.schema))
    assert fits.select(C.order_key(fits, order, bits).alias("k")).schema["k"].dataType.typeName() == "decimal"


def test_states_merge_into_days_and_unions(spark):
    import random
    rnd = random.Random(3)
    cols = "id long, symbol string, exchange string, timestamp_ms long, open double, high double, low double, close double, volume double"
    rows = [(i, rnd.choice("AB"), "x", rnd.randrange(3 * 86_400_000), *[float(rnd.randrange(100)) for _ in range(4)], float(rnd.randrange(3))) for i in range(500)]
    rows += [(1000 + i, "A", "x", 7_200_000, float(i), 1.0, 1.0, float(i), 1.0) for i in range(5)]     # ties in time
    raw = spark.createDataFrame(rows, cols)
    hourly = C.candle_state(raw, "hour")
    for want, got in ((C.hourly_candles(raw), C.candles_of(hourly)), (C.daily_candles(raw), C.candles_of(C.merge_states(hourly))),
                      (C.daily_candles(raw), C.candles_of(C.merge_states(C.candle_state(raw.filter("id % 3 = 0"), "day").union(C.candle_state(raw.filter("id % 3 <> 0"), "day")))))):
        assert got.columns == want.columns and got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    assert "SortAggregate" not in C.merge_states(hourly)._jdf.queryExecution().executedPlan().toString()


def test_wide_order_falls_back_to_struct(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a long, b long, c long")
    assert df.select(C.order_key(df, ["a", "b", "c"]).alias("k")).schema["k"].dataType.typeName() == "struct"


def test_null_order_value_is_skipped_not_an_error(spark):
    df = spark.createDataFrame([(1, "X", "e", None, 5.0, 5.0, 5.0, 5.0, 1.0),
                                (2, "X", "e", 1000, 1.0, 1.0, 1.0, 2.0, 1.0)],
                               "id long, symbol string, exchange string, timestamp_ms long, open double, "
                               "high double, low double, close double, volume double")
    rows = C.candles(df.filter("timestamp_ms IS NOT NULL OR id = 1"), "day").collect()
    valid = [r for r in rows if r["date"] is not None]
    assert valid[0]["open"] == 1.0 and valid[0]["close"] == 2.0
