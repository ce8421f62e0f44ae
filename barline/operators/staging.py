"""Staging model ``stg_raw_ohlcv``.

A view over the raw table: time columns from epoch ms, three quality flags,
and the filter that keeps rows with no flag set. Everything is a projection
and a filter, so it fuses into the scan's whole-stage-codegen span and the
predicates on raw columns reach the Parquet reader.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.functions.timecols import candle_time_seconds, date_of, hour_of

QUALITY_FLAGS = ("is_invalid_hl", "is_negative_volume", "is_zero_price")

STAGING_COLUMNS = (
    "id", "symbol", "exchange", "timestamp_ms", "candle_time", "hour_bucket", "date_bucket",
    "open", "high", "low", "close", "volume", "ingested_at",
    "is_invalid_hl", "is_negative_volume", "is_zero_price",
)


def _flag(cond: Column) -> Column:
    # CASE WHEN cond THEN true ELSE false: a NULL comparison gives false.
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def with_time_columns(raw: DataFrame) -> DataFrame:
    """``candle_time`` (integer seconds), ``hour_bucket``, ``date_bucket``."""
    t = candle_time_seconds("timestamp_ms")
    return raw.select("*", t.alias("candle_time"), hour_of(t).alias("hour_bucket"),
                      date_of(t).alias("date_bucket"))


def quality_flag_columns() -> list[Column]:
    """P02 as columns: high<low, volume<0, open<=0 or close<=0 (NULL -> false)."""
    return [
        _flag(F.col("high") < F.col("low")).alias("is_invalid_hl"),
        _flag(F.col("volume") < 0).alias("is_negative_volume"),
        _flag((F.col("open") <= 0) | (F.col("close") <= 0)).alias("is_zero_price"),
    ]


def with_quality_flags(df: DataFrame) -> DataFrame:
    """Add the three quality flags."""
    return df.select("*", *quality_flag_columns())


def passing_quality(df: DataFrame) -> DataFrame:
    """Keep rows with no flag set."""
    return df.filter(~F.col("is_invalid_hl") & ~F.col("is_negative_volume") & ~F.col("is_zero_price"))


def stg_raw_ohlcv(raw: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The 16-column staging model (time columns + flags, clean rows only).

    ``extra`` raw columns (e.g. tie-break columns) are carried after the 16.
    """
    staged = with_quality_flags(with_time_columns(raw.select(
        "id", "symbol", "exchange", "timestamp_ms", "open", "high", "low", "close",
        "volume", "ingested_at", *extra)))
    return passing_quality(staged).select(*STAGING_COLUMNS, *extra)


def register_staging_view(raw: DataFrame, name: str = "stg_raw_ohlcv") -> DataFrame:
    """P04 exposed as a temp view (the model is materialised as a view)."""
    df = stg_raw_ohlcv(raw)
    df.createOrReplaceTempView(name)
    return df


def select_columns(df: DataFrame, columns: Sequence[str],
                   rename: Mapping[str, str] | None = None) -> DataFrame:
    """Keep ``columns`` in order, renaming per ``rename`` (old -> new)."""
    rename = dict(rename or {})
    return df.select(*[F.col(c).alias(rename.get(c, c)) for c in columns])
