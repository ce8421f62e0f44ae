"""Indicators that continue from stored state (W05, W11) instead of from a series' start.

Every indicator of W11 needs a bounded past: at most ``HALO`` daily rows back
(SMA-99), or one running value (the two EMAs, OBV). The state of a series is thus
its last ``HALO`` rows with these values. A run reads the state and the new rows,
nothing older:

* ROWS-frame indicators run over halo and new rows together;
* OBV adds the new rows' signed volumes to the stored value;
* an EMA is linear in its start: run over halo and new rows, it differs from the
  true one by ``r^k`` times its difference at the last stored row, ``k`` rows ago.

Rows that come late restart their series there: ``state_before`` gives the state
as of any date from the stored tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barline.operators.ema import decay, with_emas
from barline.operators.indicators import Series, atr_col, bollinger_cols, macd_cols, rsi_col, signed_volume, sma_col
from barline.schemas import INDICATOR_COLUMNS

#: Rows that the widest frame (SMA-99) looks back.
HALO = 98
PRICES = ("high", "low", "close", "volume")
RUNNING = ("ema_12", "ema_26", "obv")


def state_columns(series: Sequence[str] = ("symbol",)) -> list[str]:
    return [*series, "date", *PRICES, *RUNNING]


def last_rows(rows: DataFrame, series: Sequence[str] = ("symbol",), n: int = HALO) -> DataFrame:
    """The last ``n`` rows of each series: its state."""
    recent = Window.partitionBy(*series).orderBy(F.col("date").desc())
    return (rows.select(*state_columns(series), F.row_number().over(recent).alias("_age")).filter(F.col("_age") <= n).drop("_age"))


def state_before(daily: DataFrame, indicators: DataFrame, date, series: Sequence[str] = ("symbol",)) -> DataFrame:
    """The state as of the day before ``date``, from the stored daily and indicator
    tables (a late row's case: both are read up to that date)."""
    keys = [*series, "date"]
    at = F.lit(date).cast("date")
    known = indicators.filter(F.col("date") < at).select(*[F.col(k).alias(f"_{k}") for k in keys], *RUNNING)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))   # a NULL symbol is one series
    return last_rows(daily.filter(F.col("date") < at).select(*keys, *PRICES).join(known, same), series)


def continue_indicators(new: DataFrame, state: DataFrame | None, series: Sequence[str] = ("symbol",)) -> DataFrame:
    """Halo and new rows with all indicators; ``is_new`` tells them apart.

    ``new``: daily rows of dates after the state's. One exchange on the series
    key, no join. A series without state starts here, as W11 does.
    """
    keys = [*series, "date"]
    rows = new.select(*keys, *PRICES, *[F.lit(None).cast("double").alias(f"_{c}") for c in RUNNING], F.lit(True).alias("is_new"))
    if state is not None:
        rows = state.select(*keys, *PRICES, *[F.col(c).alias(f"_{c}") for c in RUNNING], F.lit(False).alias("is_new")).union(rows)
    s = Series(tuple(series), "date")
    own = rows.select(
        "*", sma_col(s, "close", 7).alias("sma_7"), sma_col(s, "close", 25).alias("sma_25"), sma_col(s, "close", 99).alias("sma_99"),
        rsi_col(s, 14).alias("rsi_14"), *bollinger_cols(s, 20, 2.0), atr_col(s, 14).alias("atr_14"),
        F.when(F.col("is_new"), signed_volume(s)).otherwise(F.lit(0.0)).alias("_signed"),
        F.sum(F.col("is_new").cast("long")).over(s.upto()).alias("_k"))
    own = with_emas(own, "close", [12, 26], ["_start_12", "_start_26"], partition_by=tuple(series), order_by="date")

    def last_known(c):
        return F.last(c, ignorenulls=True).over(s.upto())

    emas = []
    for n in (12, 26):
        off = F.coalesce(last_known(F.col(f"_ema_{n}") - F.col(f"_start_{n}")), F.lit(0.0))
        ema = F.col(f"_start_{n}") + F.pow(F.lit(decay(n)[1]), F.col("_k").cast("double")) * off
        emas.append(F.coalesce(F.col(f"_ema_{n}"), ema).alias(f"ema_{n}"))
    obv = F.coalesce(last_known(F.col("_obv")), F.lit(0.0)) + F.sum("_signed").over(s.upto())
    own = own.select(*[c for c in own.columns if not c.startswith("_start")], *emas, obv.alias("obv"))
    out = own.select("*", *macd_cols(s))
    return out.select(*keys, *PRICES, "is_new", *INDICATOR_COLUMNS)
