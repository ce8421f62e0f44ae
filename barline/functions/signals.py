"""Categorical signals of the daily fact table.

Fixed values: the thresholds and labels below must equal the reference's.
RSI: below 30 'oversold', above 70 'overbought', otherwise 'neutral'.
MACD: above signal 'bullish', below 'bearish', otherwise 'neutral'.
Bands: above upper 'above_upper', below lower 'below_lower', otherwise 'within_bands'.
Run status: 'success' 1, 'running' 0.5, anything else 0.
A NULL comparison falls through to the last label.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RSI_OVERSOLD = 30.0
RSI_OVERBOUGHT = 70.0
RSI_SIGNALS = ("oversold", "overbought", "neutral")
MACD_DIRECTIONS = ("bullish", "bearish", "neutral")
BAND_POSITIONS = ("above_upper", "below_lower", "within_bands")
RUN_STATUS_CODES = {"success": 1.0, "running": 0.5}


def rsi_signal(rsi="rsi_14") -> Column:
    r = F.col(rsi)
    return (F.when(r < RSI_OVERSOLD, "oversold")
            .when(r > RSI_OVERBOUGHT, "overbought").otherwise("neutral"))


def macd_direction(macd="macd", signal="macd_signal") -> Column:
    m, s = F.col(macd), F.col(signal)
    return F.when(m > s, "bullish").when(m < s, "bearish").otherwise("neutral")


def band_position(close="close", upper="bb_upper", lower="bb_lower") -> Column:
    c = F.col(close)
    return (F.when(c > F.col(upper), "above_upper")
            .when(c < F.col(lower), "below_lower").otherwise("within_bands"))


def run_status_code(status="status") -> Column:
    s = F.col(status)
    return F.when(s == "success", 1.0).when(s == "running", 0.5).otherwise(0.0)
