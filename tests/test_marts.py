import math

import pytest

from barline.operators import candles as C
from barline.operators import indicators as IND
from barline.operators import marts as M
from pyspark.sql import functions as F


def test_fct_and_dim(twenty_days):
    inter = twenty_days.withColumn("candle_count", F.lit(1).cast("long")).withColumn("vwap", F.col("close")) \
        .withColumn("daily_return", F.col("close") / F.col("open") - 1)
    ind = IND.compute_all_indicators(twenty_days)
    fct = M.fct_market_daily(inter, ind)
    assert len(fct.columns) == 28 and fct.count() == 20
    signals = [r["rsi_signal"] for r in fct.orderBy("date").collect()]
    assert signals == ["overbought"] * 18 + ["neutral"] * 2     # RSI 71.0, then 62.5 and 54.5
    dim = M.dim_trading_pairs(inter).collect()[0]
    assert dim["total_days"] == 20
    assert dim["annualized_volatility"] == pytest.approx(dim["volatility"] * math.sqrt(365))


def test_single_day_has_null_volatility(twenty_days):
    inter = twenty_days.limit(1).withColumn("daily_return", F.lit(0.01))
    d = M.dim_trading_pairs(inter).collect()[0]
    assert d["volatility"] is None and d["sharpe_ratio"] is None
