"""Per-series window expressions (W01-W04, W13) and the SQL-macro surface.

A series is the rows of one ``partition_by`` key ordered by ``order_by``; the
defaults are one symbol's daily rows. Frames are ROWS frames, so the first
rows of a series use a shorter window rather than giving NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def _cols(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def series_window(partition_by: str | Sequence[str] = "symbol",
                  order_by: str | Sequence[str] = "date") -> WindowSpec:
    return Window.partitionBy(*_cols(partition_by)).orderBy(*_cols(order_by))


def trailing(period: int, partition_by="symbol", order_by="date") -> WindowSpec:
    """ROWS frame of the last ``period`` rows including the current one."""
    if period < 1:
        raise ValueError("period must be >= 1")
    return series_window(partition_by, order_by).rowsBetween(-(period - 1), Window.currentRow)


def sma(column: str, period: int, partition_by="symbol", order_by="date") -> Column:
    """Simple moving average over the last ``period`` rows."""
    return F.avg(column).over(trailing(period, partition_by, order_by))


def lag_col(column: str, periods: int = 1, partition_by="symbol", order_by="date") -> Column:
    """Value ``periods`` rows back in the series (NULL before the start)."""
    return F.lag(column, periods).over(series_window(partition_by, order_by))


def pct_change(column: str, periods: int = 1, partition_by="symbol", order_by="date") -> Column:
    """``(x - lag_k) / nullif(lag_k, 0)``; NULL when the lag is NULL or 0."""
    prev = lag_col(column, periods, partition_by, order_by)
    return (F.col(column) - prev) / F.nullif(prev, F.lit(0.0))


def rolling_std(column: str, period: int, partition_by="symbol", order_by="date") -> Column:
    """Sample standard deviation over the last ``period`` rows; NULL on one row."""
    return F.stddev_samp(column).over(trailing(period, partition_by, order_by))
