"""Candle roll-ups.

One ``groupBy`` per bucket size. Open and close are the first and last rows by
``order_by`` inside the bucket, taken with ``min_by``/``max_by`` on a struct of
the order columns: these are ordinary aggregates with constant state, so the
plan is partial aggregation before the shuffle, one hash exchange on the
bucket key, and final aggregation -- no sort, no self-join, and a hot key is
collapsed on the map side before it reaches a reducer. The reference's
rank-and-join form is kept as :func:`candles_rank_join` (J01) for differential
tests and the bench.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.functions.timecols import ms_to_date, ms_to_hour

DEFAULT_ORDER = ("timestamp_ms", "id")
BUCKETS = {"hour": "hour_start", "day": "date"}

# Bits of a packed order key (DECIMAL(38,0) holds 126 bits).
KEY_BITS = 126
# Inside a bucket that does not cross a UTC day only the offset into the day
# orders rows: 27 bits, whatever the epoch.
DAY_MS, DAY_BITS = 86_400_000, 27
_TYPE_BITS = {T.LongType: 64, T.IntegerType: 32, T.DateType: 32, T.ShortType: 16, T.ByteType: 8}
_DEC = T.DecimalType(38, 0)


def order_key(df: DataFrame, order_by: Sequence[str],
              bits: Mapping[str, int] | None = None, in_day: bool = False) -> Column:
    """A single orderable value for the lexicographic order of ``order_by``.

    When the columns are integral and their widths add up to at most 126 bits
    the key is one ``DECIMAL(38,0)`` (each column shifted to unsigned and
    packed): a fixed-width aggregation buffer, so ``min_by``/``max_by`` stay in
    hash aggregation. Otherwise the key is a struct, which is right too but
    makes Spark fall back to sort-based aggregation; the choice depends on
    column types alone. ``in_day`` says that keys are only compared within one
    UTC day (as inside a candle), so ``timestamp_ms`` takes 27 bits for any
    epoch. ``bits`` declares that a column fits a smaller width; where the data
    do not (one aggregation over these columns shows it), the key is the struct.
    """
    sizes = []
    for c in order_by:
        dt = type(df.schema[c].dataType)
        if in_day and c == "timestamp_ms" and dt in _TYPE_BITS:
            sizes.append(DAY_BITS)
        elif c in (bits or {}):
            sizes.append(bits[c])
        elif dt in _TYPE_BITS:
            sizes.append(_TYPE_BITS[dt])
        else:
            return F.struct(*order_by)
    if sum(sizes) > KEY_BITS:
        return F.struct(*order_by)
    key, tight = None, None
    for c, b in zip(order_by, sizes):
        v = F.col(c).cast("long") if type(df.schema[c].dataType) is T.DateType else F.col(c)
        if in_day and c == "timestamp_ms":
            shifted = F.pmod(v, F.lit(DAY_MS)).cast(_DEC)
        else:
            half = 2 ** (b - 1)
            if c in (bits or {}) and b < _TYPE_BITS[type(df.schema[c].dataType)]:
                fits = (v >= F.lit(-half)) & (v < F.lit(half))
                tight = fits if tight is None else tight & fits
            shifted = v.cast(_DEC) + F.lit(Decimal(half)).cast(_DEC)
        key = shifted if key is None else key * F.lit(Decimal(2 ** b)).cast(_DEC) + shifted
    if tight is not None and df.agg(F.bool_or(~tight)).first()[0]:
        return F.struct(*order_by)
    return key   # a NULL order value gives a NULL key: min_by/max_by skip that row


def _bucket_expr(bucket: str) -> Column:
    if bucket == "hour":
        return ms_to_hour("timestamp_ms").alias("hour_start")
    if bucket == "day":
        return ms_to_date("timestamp_ms").alias("date")
    raise ValueError(f"unknown bucket {bucket!r}; use 'hour' or 'day'")


def _present(df: DataFrame, order_by: Sequence[str]) -> list[str]:
    """Order columns that exist (a table without ``id`` orders by time only)."""
    cols = [c for c in order_by if c in df.columns]
    if not cols:
        raise ValueError(f"none of the order columns {list(order_by)} exist")
    return cols


def vwap(num: Column, den: Column) -> Column:
    """sum(close*volume)/sum(volume) when sum(volume) > 0, else NULL."""
    return F.when(den > 0, num / den)


def first_value(col: str, order_by: Sequence[str] | Column = DEFAULT_ORDER) -> Column:
    """Value of ``col`` on the first row by ``order_by`` (partial-aggregatable).

    ``order_by`` is a list of columns (struct key) or a key from :func:`order_key`.
    """
    return F.min_by(col, order_by if isinstance(order_by, Column) else F.struct(*order_by))


def last_value(col: str, order_by: Sequence[str] | Column = DEFAULT_ORDER) -> Column:
    """Value of ``col`` on the last row by ``order_by``."""
    return F.max_by(col, order_by if isinstance(order_by, Column) else F.struct(*order_by))


#: Columns of a mergeable candle: its prices with the order keys of the first and
#: last row, and the sums that the volume-weighted price needs.
STATE_COLUMNS = ("open", "open_key", "high", "low", "close", "close_key", "volume", "row_count", "close_volume")


def candle_state(raw: DataFrame, bucket: str = "hour", order_by: Sequence[str] = DEFAULT_ORDER,
                 keys: Sequence[str] = ("symbol", "exchange"), order_bits: Mapping[str, int] | None = None,
                 at: Column | None = None) -> DataFrame:
    """Mergeable candles per ``keys`` and bucket: hourly states merge into days,
    and the states of two disjoint sets of rows into those of their union, without
    the raw rows. Keys order rows within one UTC day, the largest bucket. ``at``
    gives the bucket where a column has it already."""
    order_by = _present(raw, order_by)
    ordered = raw.select("*", order_key(raw, order_by, order_bits, in_day=True).alias("_ord"))
    slot = _bucket_expr(bucket) if at is None else at.alias(BUCKETS[bucket])
    return ordered.groupBy(*keys, slot).agg(
        first_value("open", F.col("_ord")).alias("open"), F.min("_ord").alias("open_key"),
        F.max("high").alias("high"), F.min("low").alias("low"),
        last_value("close", F.col("_ord")).alias("close"), F.max("_ord").alias("close_key"),
        F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("close") * F.col("volume")).alias("close_volume"))


def merge_states(state: DataFrame, bucket: str = "day", keys: Sequence[str] = ("symbol", "exchange")) -> DataFrame:
    """States of one bucket size merged into those of ``bucket`` (an hour's or a day's)."""
    own = next(b for b in BUCKETS.values() if b in state.columns)
    to = F.col(own) if own == BUCKETS[bucket] else F.to_date(own)
    return state.groupBy(*keys, to.alias(BUCKETS[bucket])).agg(
        F.min_by("open", "open_key").alias("open"), F.min("open_key").alias("open_key"),
        F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "close_key").alias("close"), F.max("close_key").alias("close_key"),
        F.sum("volume").alias("volume"), F.sum("row_count").alias("row_count"), F.sum("close_volume").alias("close_volume"))


def candles_of(state: DataFrame, keys: Sequence[str] = ("symbol", "exchange"), count_name: str = "trade_count") -> DataFrame:
    """The candles (A01/A02) of states."""
    own = next(b for b in BUCKETS.values() if b in state.columns)
    return state.select(*keys, own, "open", "high", "low", "close", "volume", F.col("row_count").alias(count_name),
                        vwap(F.col("close_volume"), F.col("volume")).alias("vwap"))


def candles(raw: DataFrame, bucket: str = "hour", order_by: Sequence[str] = DEFAULT_ORDER,
            keys: Sequence[str] = ("symbol", "exchange"), count_name: str = "trade_count",
            timeframe: str | None = None, order_bits: Mapping[str, int] | None = None) -> DataFrame:
    """OHLCV candles per ``keys`` and time bucket.

    open = first open, high = max, low = min, close = last close, volume = sum,
    ``trade_count`` = number of input candles, vwap per A03. ``timeframe``
    optionally keeps only messages of that timeframe first (X10).
    """
    if timeframe is not None:
        raw = raw.filter(F.col("timeframe") == timeframe)
    state = candle_state(raw, bucket, order_by, keys, order_bits)
    return candles_of(state, keys, count_name)


def hourly_candles(raw: DataFrame, order_by: Sequence[str] = DEFAULT_ORDER,
                   order_bits: Mapping[str, int] | None = None) -> DataFrame:
    """A01 over raw (unfiltered) candles."""
    return candles(raw, "hour", order_by, order_bits=order_bits)


def daily_candles(raw: DataFrame, order_by: Sequence[str] = DEFAULT_ORDER,
                  order_bits: Mapping[str, int] | None = None) -> DataFrame:
    """A02 over raw (unfiltered) candles."""
    return candles(raw, "day", order_by, order_bits=order_bits)


def int_ohlcv_daily(staged: DataFrame, order_by: Sequence[str] = DEFAULT_ORDER,
                    order_bits: Mapping[str, int] | None = None) -> DataFrame:
    """Daily candles of the *staged* rows with ``candle_count`` and
    ``daily_return`` = last close / first open - 1 (NULL when first open <= 0)."""
    day = F.col("date" if "date" in staged.columns else "date_bucket")
    return int_of(candle_state(staged, "day", order_by, order_bits=order_bits, at=day))


def int_of(state: DataFrame) -> DataFrame:
    """A05 of daily states."""
    daily = candles_of(state, count_name="candle_count")
    return daily.withColumn("daily_return", F.when(F.col("open") > 0, F.col("close") / F.col("open") - 1))


def first_last_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                    which: str = "first") -> DataFrame:
    """The whole first (or last) row of each key by ``order_by``.

    Written as ``min_by``/``max_by`` of a struct of all columns, so it is a
    partial aggregation (one exchange, constant state per key on each map
    task) instead of a ``row_number`` window that would pull a hot key's rows
    into one sorted task. Ties on the full order are impossible when
    ``order_by`` is a row key.
    """
    others = [c for c in df.columns if c not in keys]
    pick = F.min_by if which == "first" else F.max_by
    row = pick(F.struct(*others), F.struct(*order_by)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def candles_rank_join(raw: DataFrame, bucket: str = "hour",
                      order_by: Sequence[str] = DEFAULT_ORDER) -> DataFrame:
    """The rank-and-join form: rank the rows of a bucket, pick its two ends,
    join them to the bucket's totals.

    Kept as the differential check of :func:`candles` and for the bench; it
    plans windows, sorts and a join, against the one exchange of the
    ``min_by``/``max_by`` form.
    """
    slot = ["symbol", "exchange", BUCKETS[bucket]]
    bucketed = raw.select("*", _bucket_expr(bucket))
    within = Window.partitionBy(*slot)
    placed = bucketed.select(*slot, "open", "close", F.count(F.lit(1)).over(within).alias("size"),
                             F.row_number().over(within.orderBy(*_present(raw, order_by))).alias("place"))
    ends = placed.filter("place = 1 OR place = size").groupBy(*slot).agg(
        F.max(F.when(F.col("place") == 1, F.col("open"))).alias("open"),
        F.max(F.when(F.col("place") == F.col("size"), F.col("close"))).alias("close"))
    totals = bucketed.groupBy(*slot).agg(
        F.max("high").alias("high"), F.min("low").alias("low"), F.sum("volume").alias("volume"),
        F.count(F.lit(1)).alias("trade_count"), F.sum(F.col("close") * F.col("volume")).alias("_pv"))
    return totals.join(ends, slot).select(*slot, "open", "high", "low", "close", "volume", "trade_count",
                                          vwap(F.col("_pv"), F.col("volume")).alias("vwap"))
