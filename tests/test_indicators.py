import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barline.operators import indicators as IND
from barline.operators.ema import block_plan, decay, with_ema, with_emas
from barline.schemas import INDICATOR_COLUMNS


def test_sma_of_seven(twenty_days):
    rows = IND.compute_sma(twenty_days, "close", 7).orderBy("date").collect()
    assert rows[6]["sma_7"] == pytest.approx(106.0)    # 100, 102, ... 112
    assert rows[0]["sma_7"] == pytest.approx(100.0)    # shorter window, not NULL


def test_rsi_up_then_down(twenty_days):
    vals = [r["rsi_14"] for r in IND.compute_rsi(twenty_days).orderBy("date").collect()]
    assert vals[:15] == [100.0] * 15                   # no loss yet
    assert vals[15] == pytest.approx(100 - 100 / (1 + 26 / 3))  # 13 gains of 2, one loss of 3


def test_atr_of_constant_range(twenty_days):
    vals = [r["atr_14"] for r in IND.compute_atr(twenty_days).collect()]
    assert all(v == pytest.approx(10.0) for v in vals)  # high - low; moves to the last close are smaller


def test_obv_up_then_down(twenty_days):
    rows = IND.compute_obv(twenty_days).orderBy("date").collect()
    assert rows[0]["obv"] == 0.0 and rows[3]["obv"] == 11.0 + 12 + 13
    assert rows[15]["obv"] == sum(10.0 + i for i in range(1, 15)) - 25.0


def test_bollinger_first_row_null(twenty_days):
    rows = IND.compute_bollinger_bands(twenty_days).orderBy("date").collect()
    assert rows[0]["bb_upper"] is None and rows[0]["bb_middle"] == 100.0
    assert rows[5]["bb_upper"] > rows[5]["bb_middle"] > rows[5]["bb_lower"]


def test_all_indicators_shape(twenty_days):
    out = IND.compute_all_indicators(twenty_days)
    assert out.columns == ["symbol", "date", *INDICATOR_COLUMNS]
    assert len(out.columns) == 16 and out.count() == 20


@pytest.mark.parametrize("span", [1, 2, 12, 26, 200])
def test_ema_matches_pandas_ewm(spark, span):
    rng = np.random.default_rng(7)
    n = 1500
    pdf = pd.DataFrame({"symbol": np.repeat(["A", "B"], n), "date": np.tile(np.arange(n), 2),
                        "close": np.concatenate([100 + rng.standard_normal(n).cumsum(),
                                                 5 + rng.random(n)])})
    df = spark.createDataFrame(pdf)
    got = with_ema(df, "close", span).toPandas().sort_values(["symbol", "date"])
    want = pdf.sort_values(["symbol", "date"]).groupby("symbol")["close"] \
        .transform(lambda s: s.ewm(span=span, adjust=False).mean())
    assert np.allclose(got[f"ema_{span}"].to_numpy(), want.to_numpy(), rtol=1e-11, atol=1e-11)


def pandas_ema(df, span):
    """U01, the oracle: the pandas EMA of each series by applyInPandas."""
    def per_series(pdf):
        pdf = pdf.sort_values("date", kind="mergesort")
        return pdf.assign(ema=pdf["close"].astype("float64").ewm(span=span, adjust=False).mean())
    return df.select("symbol", "date", "close").groupBy("symbol").applyInPandas(
        per_series, "symbol string, date date, close double, ema double")


def test_ema_native_equals_apply_in_pandas(twenty_days):
    a = with_ema(twenty_days, "close", 12).select("date", F.round("ema_12", 8).alias("e"))
    b = pandas_ema(twenty_days, 12).select("date", F.round("ema", 8).alias("e"))
    assert a.exceptAll(b).count() == 0


@pytest.mark.parametrize("spans", [[2], [12, 26], [1, 2, 12, 26, 200, 5000]])
def test_block_plan_bounds(spans):
    plan = block_plan(spans)
    assert sorted(n for _, folds in plan for n in folds) == [n for n in spans if n > 1]
    for block, folds in plan:
        for n, fold in folds.items():
            assert decay(n)[1] ** -(block - 1) < np.exp(500.5)
            assert fold <= 8 and (decay(n)[1] ** block) ** fold < 2.0 ** -1000


@pytest.mark.parametrize("split", [False, True])
def test_ema_over_many_blocks_and_null_series(spark, split):
    rng = np.random.default_rng(3)
    n = 9000                                   # 20 blocks of span 2, 4 of spans 12 and 26
    close = 1e6 + rng.standard_normal(n).cumsum()
    df = spark.createDataFrame([(None, int(t), float(v)) for t, v in enumerate(close)],
                               "symbol string, date long, close double")
    got = with_emas(df, "close", [2, 12, 26], split=split)
    got = got.toPandas().sort_values("date")
    for span in (2, 12, 26):
        want = pd.Series(close).ewm(span=span, adjust=False).mean()
        assert np.allclose(got[f"ema_{span}"].to_numpy(), want.to_numpy(), rtol=1e-12, atol=0)


def test_indicator_plan_is_one_exchange_and_prunes(spark, twenty_days, tmp_path, capsys):
    path = str(tmp_path / "daily")
    twenty_days.write.parquet(path)
    ind = IND.compute_all_indicators(spark.read.parquet(path)).filter("symbol = 'X'")
    ind.explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") + plan.count("\nArguments: hashpartitioning") == 1
    assert "Join" not in plan and "EqualTo(symbol,X)" in plan
    ind.select("date", "rsi_14").explain("formatted")
    assert "_ema" not in capsys.readouterr().out


def test_series_by_exchange(spark, twenty_days):
    two = twenty_days.unionByName(twenty_days.withColumn("exchange", F.lit("other"))
                              .withColumn("close", F.col("close") * 2))
    out = IND.compute_all_indicators(two, partition_by=("symbol", "exchange"))
    assert out.count() == 40
    assert out.filter("exchange = 'other'").agg(F.min("sma_7")).collect()[0][0] == 2 * 100.0


@pytest.mark.parametrize("span", [2, 26])
def test_ema_split_series_position_matches_pandas(spark, span):
    rng = np.random.default_rng(5)
    n = 4000
    pdf = pd.DataFrame({"symbol": ["HOT"] * n, "t": np.arange(n) * 7,
                        "close": 50 + rng.standard_normal(n).cumsum()})
    df = spark.createDataFrame(pdf)
    got = with_emas(df, "close", [span], partition_by="symbol", order_by="t",
                    split=True).toPandas().sort_values("t")
    want = pdf["close"].ewm(span=span, adjust=False).mean()
    assert np.allclose(got[f"ema_{span}"].to_numpy(), want.to_numpy(), rtol=1e-11, atol=1e-11)


@pytest.mark.parametrize("bucket_rows", [40, 1000])
def test_split_series_indicators_equal_per_series(spark, bucket_rows):
    from barline.operators.candles import daily_candles
    from barline.sources.candle_views import L_BITS, L_ORDER, raw_l
    daily = daily_candles(raw_l(spark, "/root/testdata/sf0.001"), L_ORDER, L_BITS).cache()
    a = IND.compute_all_indicators(daily).toPandas().sort_values(["symbol", "date"])
    b = IND.compute_all_indicators(daily, split=True,
                                   bucket_rows=bucket_rows).toPandas().sort_values(["symbol", "date"])
    assert len(a) == len(b) > 0
    for c in INDICATOR_COLUMNS:
        assert np.allclose(a[c].to_numpy(dtype=float), b[c].to_numpy(dtype=float),
                           rtol=1e-9, atol=1e-7, equal_nan=True), c
