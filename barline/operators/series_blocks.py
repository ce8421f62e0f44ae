"""Exact bounded-lookback windows on series of any length (W01-W04, W13 at scale).

``Window.partitionBy(series)`` sends a whole series to one task. That is
fine for daily candles (a series has at most one row per day), but not when a
macro window (W02-W04) runs over intraday rows, where one symbol may hold a
third of all rows. Here a series is cut into buckets of at most ``bucket_rows``
rows plus a halo:

1. **Global row position without a whole-series sort.** Rows are range-partitioned
   by (series, order) and numbered inside their partition, so a hot series, or one
   hot day of it, is spread over as many tasks as its size asks for. Counts per
   (series, partition), one small row each, and a running sum over them give the
   position at which each partition's share of a series begins. The dealt rows are
   stored once, as both steps read them.
2. **Buckets with a halo.** Bucket ``b = g div M`` (``M >= lookback``). A row
   that is among the last ``lookback`` rows of its bucket is also sent, as a
   halo row, to bucket ``b + 1``.
3. **Windows per (series, bucket)**, ordered by ``g``. Every frame reaching
   at most ``lookback`` rows back (``rowsBetween(-m, 0)`` with
   ``m <= lookback``, ``lag(k)`` with ``k <= lookback``) sees the same rows as
   over the whole series. Halo rows are dropped afterwards.

No window holds more than ``M + lookback`` rows of one series, and no sort more than
a range partition (rows that tie in the whole order go together); the result is
exact, not sampled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barline.session import stored


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])   # a NULL series key is still one series
        cond = c if cond is None else cond & c
    return cond


def with_series_position(df: DataFrame, partition_by, order_by, out: str = "_g",
                         partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 0-based position of the row in its series by ``order_by``
    (``partitions``: how many range partitions; by default as many as Spark makes)."""
    pb, ob = _cols(partition_by), _cols(order_by)
    dealt = df.repartitionByRange(partitions, *pb, *ob) if partitions else df.repartitionByRange(*pb, *ob)
    # the id counts the rows of a partition in order, below the partition's number
    rows = stored(dealt.sortWithinPartitions(*pb, *ob).withColumn("_at", F.monotonically_increasing_id()), "series_rows")
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    shares = rows.groupBy(*pb, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*pb).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = shares.select(*pb, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_start"))
    joined = rows.join(starts, _on(rows, starts, [*pb, "_part"]), "inner").select(rows["*"], starts["_start"])
    return joined.withColumn(out, F.col("_start") + F.col("_at")).drop("_at", "_part", "_start")


def bounded_lookback(df: DataFrame, partition_by, order_by, lookback: int,
                     columns: Callable[[WindowSpec], list[Column]],
                     bucket_rows: int = 1 << 20, position: str | None = None) -> DataFrame:
    """Add the window ``columns`` computed as if partitioned by the whole series.

    ``columns(w)`` receives ``w = partition by (series, bucket) order by
    position`` and returns aliased columns whose frames reach at most
    ``lookback`` rows back. ``position`` names an existing series-position
    column (from :func:`with_series_position`); otherwise it is computed.
    """
    pb = _cols(partition_by)
    m = max(int(bucket_rows), int(lookback), 1)
    if position is None:
        pos = with_series_position(df, partition_by, order_by, "_g")
    else:
        pos = df.withColumn("_g", F.col(position))
    own = F.floor(F.col("_g") / m)
    halo = (own + 1) * m - lookback
    buckets = F.when((F.lit(lookback) > 0) & (F.col("_g") >= halo), F.array(own, own + 1)) \
        .otherwise(F.array(own))
    spread = pos.withColumn("_bk", F.explode(buckets))
    w = Window.partitionBy(*pb, "_bk").orderBy("_g")
    out = spread.select("*", *columns(w)).filter(F.col("_bk") == own)
    return out.drop("_bk") if position == "_g" else out.drop("_g", "_bk")


def macro_columns(column: str, sma_periods: Sequence[int] = (), std_periods: Sequence[int] = (),
                  lags: Sequence[int] = (), pct_periods: Sequence[int] = ()) -> tuple[
                      int, Callable[[WindowSpec], list[Column]]]:
    """The W01-W04/W13 family as ``(lookback, columns)`` for :func:`bounded_lookback`."""
    lookback = max([p - 1 for p in (*sma_periods, *std_periods)] + [*lags, *pct_periods, 0])

    def cols(w: WindowSpec) -> list[Column]:
        out = [F.avg(column).over(w.rowsBetween(-(p - 1), 0)).alias(f"sma_{p}") for p in sma_periods]
        out += [F.stddev_samp(column).over(w.rowsBetween(-(p - 1), 0)).alias(f"std_{p}")
                for p in std_periods]
        out += [F.lag(column, k).over(w).alias(f"{column}_lag_{k}") for k in lags]
        for k in pct_periods:
            prev = F.lag(column, k).over(w)
            out.append(((F.col(column) - prev) / F.nullif(prev, F.lit(0.0))).alias(f"pct_{k}"))
        return out
    return lookback, cols


def with_running_sum(df: DataFrame, partition_by, order_by, value: str, block: Column,
                     out: str) -> DataFrame:
    """``out`` = running sum of ``value`` over the whole series (unbounded
    preceding .. current row), without a whole-series window: a running sum
    inside ``(series, block)`` plus the sum of all earlier blocks (a running
    sum over the small per-block totals table)."""
    pb, ob = _cols(partition_by), _cols(order_by)
    b = df.withColumn("_blk", block)
    totals = b.groupBy(*pb, "_blk").agg(F.sum(value).alias("_t"))
    before = Window.partitionBy(*pb).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*pb, "_blk", F.coalesce(F.sum("_t").over(before), F.lit(0.0))
                            .alias("_o"))
    upto = Window.partitionBy(*pb, "_blk").orderBy(*ob) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = b.withColumn("_local", F.sum(value).over(upto))
    joined = rows.join(offsets, _on(rows, offsets, [*pb, "_blk"]), "inner") \
        .select(rows["*"], offsets["_o"])
    return joined.withColumn(out, F.col("_o") + F.col("_local")).drop("_blk", "_local", "_o")
