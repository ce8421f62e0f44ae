"""Marts: ``fct_market_daily`` (M01, J02, P06-P08) and ``dim_trading_pairs``
(M02, A06, A07)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.functions.signals import band_position, macd_direction, rsi_signal
from barline.schemas import INDICATOR_COLUMNS

DAYS_PER_YEAR = 365.0  # fixed value: crypto trades every day

FACT_COLUMNS = (
    "symbol", "exchange", "date", "open", "high", "low", "close", "volume", "candle_count",
    "vwap", "daily_return", *INDICATOR_COLUMNS, "rsi_signal", "macd_signal_direction",
    "bb_position",
)


def join_indicators(daily: DataFrame, indicators: DataFrame,
                    keys: Sequence[str] = ("symbol", "date")) -> DataFrame:
    """Daily facts LEFT JOIN indicators on ``keys``.

    Both sides are one row per series and day; Catalyst/AQE picks the join
    (broadcast only when the measured indicator side is small).
    """
    ind = indicators.select(*keys, *INDICATOR_COLUMNS)
    return daily.join(ind, list(keys), "left")


def with_signals(df: DataFrame) -> DataFrame:
    """P06-P08."""
    return df.select("*", rsi_signal().alias("rsi_signal"),
                     macd_direction().alias("macd_signal_direction"),
                     band_position().alias("bb_position"))


def fct_market_daily(int_daily: DataFrame, indicators: DataFrame,
                     keys: Sequence[str] = ("symbol", "date")) -> DataFrame:
    """int_ohlcv_daily + the 14 indicators + three signals (28 columns)."""
    return with_signals(join_indicators(int_daily, indicators, keys)).select(*FACT_COLUMNS)


def pair_stats(int_daily: DataFrame) -> DataFrame:
    """Per (symbol, exchange) first/last date, day count, averages,
    sample stddev of the daily return (``volatility``), all-time low/high."""
    return int_daily.groupBy("symbol", "exchange").agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count(F.lit(1)).alias("total_days"),
        F.avg("volume").alias("avg_daily_volume"),
        F.avg("daily_return").alias("avg_daily_return"),
        F.stddev_samp("daily_return").alias("volatility"),
        F.min("low").alias("all_time_low"),
        F.max("high").alias("all_time_high"),
    )


def with_risk_ratios(stats: DataFrame) -> DataFrame:
    """Annualised volatility and Sharpe ratio (0 % risk-free rate)."""
    root = math.sqrt(DAYS_PER_YEAR)
    vol = F.col("volatility")
    return stats.select(
        "*", (vol * F.lit(root)).alias("annualized_volatility"),
        F.when(vol > 0, (F.col("avg_daily_return") * F.lit(DAYS_PER_YEAR)) / (vol * F.lit(root)))
        .alias("sharpe_ratio"))


def dim_trading_pairs(int_daily: DataFrame) -> DataFrame:
    """M02 = A06 + A07."""
    return with_risk_ratios(pair_stats(int_daily))
