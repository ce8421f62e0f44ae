"""Exponential moving average as a blocked scan of built-in window functions.

``y_0 = x_0``, ``y_t = a*x_t + r*y_(t-1)`` with ``a = 2/(span+1)``, ``r = 1-a``
(pandas ``ewm(span, adjust=False)``).

Unrolled, ``y_t = sum_j w_j r^(t-j)`` with ``w_0 = x_0`` and ``w_j = a*x_j``. A
plain running sum of ``w_j r^-j`` overflows, so each series is cut into blocks
of ``B`` rows with ``r^-B <= e^500``:

1. inside block ``c`` (rows ``k = 0..B-1``) a running sum over the window
   ``(series, c)`` gives ``s_k = r^k * sum_(j<=k) w_j r^-j``, the EMA of the
   block alone;
2. the EMA entering block ``c`` is ``carry_c = sum_(m>=1) R^(m-1) s_end(c-m)``
   with ``R = r^B``, over the last ``K`` block ends (the running value at
   ``k = B-1``). ``R^K < 2^-1074``: older terms weigh less than the smallest
   double;
3. ``y = s_k + r^(k+1) * carry_c``.

Spans share one block size as long as their decay rates lie within a factor
``RATE_RATIO`` of each other, which keeps ``K <= 8``; others get a group of
their own. The rule depends on the spans alone.

A series in one task (the default) takes the ends from RANGE frames
over ``c``: one exchange on the series key, no join, and a filter on that key
reaches the scan. With a split position no step holds a series: blocks hold
``B`` rows, each group sends its ends to the next ``K`` blocks, where they are
grouped by ``(series, block)`` and joined back once for all its spans.

``x`` must be non-NULL and finite (closes are NOT NULL), below 1e90.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOG_BOUND = 500.0         # r^-B <= e^500 inside a block
RATE_RATIO = 5.0          # greatest ratio of decay rates that share a block size
SMALLEST_DOUBLE_LOG = 1074 * math.log(2.0)


def decay(span: int) -> tuple[float, float]:
    """(alpha, r) of a span."""
    if span < 1:
        raise ValueError("span must be >= 1")
    alpha = 2.0 / (span + 1.0)
    return alpha, 1.0 - alpha


def block_plan(spans: Sequence[int]) -> list[tuple[int, dict[int, int]]]:
    """``(block size B, {span: K})`` for each group of spans; span 1 needs none."""
    rates = sorted({(-math.log(decay(n)[1]), n) for n in spans if n > 1}, reverse=True)
    groups: list[list[tuple[float, int]]] = []
    for rate, n in rates:
        if groups and groups[-1][0][0] <= RATE_RATIO * rate:
            groups[-1].append((rate, n))
        else:
            groups.append([(rate, n)])
    plan = []
    for group in groups:
        block = int(LOG_BOUND // group[0][0])
        plan.append((block, {n: math.ceil(SMALLEST_DOUBLE_LOG / (block * rate)) for rate, n in group}))
    return plan


def _names(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def with_ema(df: DataFrame, column: str, span: int, out: str | None = None,
             partition_by: str | Sequence[str] = "symbol",
             order_by: str | Sequence[str] = "date") -> DataFrame:
    """Add ``out`` (default ``ema_<span>``) = EMA of ``column`` per series."""
    return with_emas(df, column, [span], [out] if out else None, partition_by, order_by)


def with_emas(df: DataFrame, column: str, spans: Sequence[int],
              outs: Sequence[str] | None = None,
              partition_by: str | Sequence[str] = "symbol",
              order_by: str | Sequence[str] = "date",
              split: bool = False,
              position: str | None = None) -> DataFrame:
    """Add one EMA column per span (default names ``ema_<span>``).

    With ``split`` the row index comes from
    :func:`barline.operators.series_blocks.with_series_position` instead of a whole-series ``row_number``, and no step holds a whole series:
    use it for intraday or hot series. ``position`` names an existing 0-based
    index and takes the split form too; then ``df`` should be a stored table,
    as the block ends read it again.
    """
    outs = list(outs) if outs else [f"ema_{n}" for n in spans]
    pb, ob = _names(partition_by), _names(order_by)
    i = "_ema_i"
    split = split or position is not None
    if position is not None:
        rows = df.withColumn(i, F.col(position))
    elif split:
        from barline.operators.series_blocks import with_series_position
        rows = with_series_position(df, pb, ob, i)
    else:
        rows = df.withColumn(i, (F.row_number().over(Window.partitionBy(*pb).orderBy(*ob)) - 1).cast("long"))
    x = F.col(column).cast("double")
    value = {1: x}
    for g, (block, folds) in enumerate(block_plan(spans)):
        rows = _local_emas(rows, x, pb, i, g, block, folds)
        rows = (_joined_carries if split else _window_carries)(rows, pb, g, block, folds)
        step = F.col(f"_ema_k{g}").cast("double") + 1
        for n in folds:
            carry = F.coalesce(F.col(f"_ema_carry{n}"), F.lit(0.0))
            value[n] = F.col(f"_ema_s{n}") + F.pow(F.lit(decay(n)[1]), step) * carry
    return rows.select(*df.columns, *[value[n].alias(out) for n, out in zip(spans, outs)])


def _local_emas(rows: DataFrame, x: Column, pb: list[str], i: str, g: int, block: int,
                folds: dict[int, int]) -> DataFrame:
    """Add block ``_ema_c``, row in block ``_ema_k`` and each span's EMA of the block alone."""
    c, k = f"_ema_c{g}", f"_ema_k{g}"
    rows = rows.withColumn(c, F.floor(F.col(i) / block)).withColumn(k, F.col(i) % block)
    so_far = (Window.partitionBy(*pb, c).orderBy(k)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    at = F.col(k).cast("double")
    local = []
    for n in folds:
        alpha, r = decay(n)
        w = F.when(F.col(i) == 0, x).otherwise(F.lit(alpha) * x)
        local.append((F.pow(F.lit(r), at) * F.sum(w * F.pow(F.lit(r), -at)).over(so_far)).alias(f"_ema_s{n}"))
    return rows.select("*", *local)


def _window_carries(rows: DataFrame, pb: list[str], g: int, block: int, folds: dict[int, int]) -> DataFrame:
    """Add each span's carry from RANGE frames that hold one earlier block each."""
    c, k = f"_ema_c{g}", f"_ema_k{g}"
    by_block = Window.partitionBy(*pb).orderBy(c)
    ends, carries = [], []
    for n, fold in folds.items():
        is_end = F.when(F.col(k) == block - 1, F.col(f"_ema_s{n}"))
        carry = F.lit(0.0)
        for m in range(fold, 0, -1):
            end = f"_ema_end{n}_{m}"
            ends.append(F.max(is_end).over(by_block.rangeBetween(-m, -m)).alias(end))
            carry = carry * F.lit(decay(n)[1] ** block) + F.coalesce(F.col(end), F.lit(0.0))
        carries.append(carry.alias(f"_ema_carry{n}"))
    return rows.select("*", *ends).select(*rows.columns, *carries)


def _joined_carries(rows: DataFrame, pb: list[str], g: int, block: int, folds: dict[int, int]) -> DataFrame:
    """Add each span's carry by sending block ends to the blocks that follow."""
    c, k = f"_ema_c{g}", f"_ema_k{g}"
    reach = max(folds.values())
    sent = (rows.filter(F.col(k) == block - 1)
            .select(*pb, F.col(c).alias("_from"), *[f"_ema_s{n}" for n in folds],
                    F.explode(F.sequence(F.col(c) + 1, F.col(c) + reach)).alias("_to")))
    # At most one end a distance, so max() only picks it: the sum runs in one fixed order.
    got = sent.groupBy(*pb, "_to").agg(*[
        F.max(F.when(F.col("_to") - F.col("_from") == m, F.col(f"_ema_s{n}"))).alias(f"_ema_end{n}_{m}")
        for n, fold in folds.items() for m in range(1, fold + 1)])
    carries = []
    for n, fold in folds.items():
        carry = F.lit(0.0)
        for m in range(fold, 0, -1):
            carry = carry * F.lit(decay(n)[1] ** block) + F.coalesce(F.col(f"_ema_end{n}_{m}"), F.lit(0.0))
        carries.append(carry.alias(f"_ema_carry{n}"))
    got = got.select(*[F.col(p).alias(f"_ema_to_{p}") for p in pb], "_to", *carries)
    # Null-safe on the series key: a NULL symbol is still one series.
    same = [F.col(p).eqNullSafe(F.col(f"_ema_to_{p}")) for p in pb] + [F.col(c) == F.col("_to")]
    return rows.join(got, same, "left").select(*rows.columns, *[f"_ema_carry{n}" for n in folds])
