"""Epoch-millisecond time columns.

All results are ``TIMESTAMP`` in the session zone, which the library pins to
UTC, so a bucket boundary is a UTC boundary.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def candle_time_exact(ms="timestamp_ms") -> Column:
    """epoch ms -> timestamp keeping the milliseconds (no float step)."""
    return F.timestamp_millis(_c(ms))


def candle_time_seconds(ms="timestamp_ms") -> Column:
    """epoch ms -> timestamp after *integer* division to seconds.

    Differs from F01 in the sub-second part and for negative ms
    (``div`` truncates toward zero, as in the staging model).
    """
    m = _c(ms).cast("long")
    return F.timestamp_seconds(((m - m % 1000) / 1000).cast("long"))


def hour_of(ts) -> Column:
    """truncate a timestamp to its hour."""
    return F.date_trunc("hour", _c(ts))


def date_of(ts) -> Column:
    """timestamp -> date (in the session zone, UTC)."""
    return F.to_date(_c(ts))


def ms_to_hour(ms="timestamp_ms") -> Column:
    return hour_of(candle_time_exact(ms))


def ms_to_date(ms="timestamp_ms") -> Column:
    return date_of(candle_time_exact(ms))
