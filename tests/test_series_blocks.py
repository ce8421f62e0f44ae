import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barline.functions import series as SR
from barline.operators.series_blocks import bounded_lookback, macro_columns, with_series_position


@pytest.fixture
def hot(spark):
    rng = np.random.default_rng(11)
    n_hot, n_cold = 3000, 200
    ts = np.concatenate([np.sort(rng.choice(10 ** 9, n_hot, replace=False)),
                         np.sort(rng.choice(10 ** 9, n_cold, replace=False))])
    pdf = pd.DataFrame({"symbol": ["HOT"] * n_hot + ["cold"] * n_cold, "timestamp_ms": ts,
                        "close": 100 + rng.standard_normal(n_hot + n_cold).cumsum()})
    return spark.createDataFrame(pdf)


@pytest.mark.parametrize("partitions", [None, 1, 40])
def test_position_equals_row_number(hot, partitions):
    got = with_series_position(hot, "symbol", "timestamp_ms", partitions=partitions)
    ref = hot.withColumn("_g", F.row_number().over(SR.series_window("symbol", "timestamp_ms")) - 1)
    assert got.exceptAll(ref.select(*got.columns)).count() == ref.select(*got.columns).exceptAll(got).count() == 0


def test_one_day_of_one_series_is_spread_over_tasks(spark, monkeypatch):
    from barline.operators import series_blocks as SB
    kept = []
    real = SB.stored
    monkeypatch.setattr(SB, "stored", lambda df, name: kept.append(out := real(df, name)) or out)
    rows = [("HOT", 86_400_000 + 7 * i % 5003, i) for i in range(5000)] + [(None, i, i) for i in range(50)] + [("cold", None, 1), ("cold", 3, 2)]
    df = spark.createDataFrame(rows, "symbol string, timestamp_ms long, id long")
    got = with_series_position(df, "symbol", ("timestamp_ms", "id"), partitions=16)
    ref = df.withColumn("_g", F.row_number().over(SR.series_window("symbol", ("timestamp_ms", "id"))) - 1)
    assert got.exceptAll(ref.select(*got.columns)).count() == 0 and got.count() == len(rows)
    sizes = [r["count"] for r in kept[0].filter("symbol = 'HOT'").groupBy(F.shiftright("_at", 33)).count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 1000   # one series, one day, many tasks
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan


@pytest.mark.parametrize("bucket_rows", [1, 7, 64, 100000])
def test_bounded_lookback_equals_whole_series_windows(hot, bucket_rows):
    lookback, cols = macro_columns("close", sma_periods=(5, 25), std_periods=(20,), lags=(1, 5),
                                   pct_periods=(1,))
    got = bounded_lookback(hot, "symbol", "timestamp_ms", lookback, cols, bucket_rows)
    ref = hot.select("*", SR.sma("close", 5, "symbol", "timestamp_ms").alias("sma_5"),
                     SR.sma("close", 25, "symbol", "timestamp_ms").alias("sma_25"),
                     SR.rolling_std("close", 20, "symbol", "timestamp_ms").alias("std_20"),
                     SR.lag_col("close", 1, "symbol", "timestamp_ms").alias("close_lag_1"),
                     SR.lag_col("close", 5, "symbol", "timestamp_ms").alias("close_lag_5"),
                     SR.pct_change("close", 1, "symbol", "timestamp_ms").alias("pct_1"))
    a = got.toPandas().sort_values(["symbol", "timestamp_ms"]).reset_index(drop=True)
    b = ref.toPandas().sort_values(["symbol", "timestamp_ms"]).reset_index(drop=True)
    assert len(a) == len(b) == 3200
    for c in ("sma_5", "sma_25", "std_20", "close_lag_1", "close_lag_5", "pct_1"):
        assert np.allclose(a[c].to_numpy(dtype=float), b[c].to_numpy(dtype=float),
                           rtol=1e-9, atol=1e-9, equal_nan=True), c
