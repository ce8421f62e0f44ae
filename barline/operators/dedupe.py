"""Idempotent loading: insert-ignore (S07, J03) and the incremental filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from barline.operators.candles import first_last_rows
from barline.schemas import CANDLE_KEY


def new_rows(batch: DataFrame, target: DataFrame | None,
             key: Sequence[str] = CANDLE_KEY,
             order_by: Sequence[str] = ("timestamp_ms", "id"),
             prune_on: str | None = None) -> DataFrame:
    """The rows of ``batch`` an ``INSERT ... ON CONFLICT DO NOTHING`` would add.

    Duplicates inside the batch collapse to the first row by ``order_by``
    (a deterministic stand-in for "first inserted"), then rows whose key is
    already in ``target`` are dropped by a ``left_anti`` join (J03). The
    target side is pruned to the key columns; with ``prune_on`` (a column of
    both sides, e.g. a date partition column) it is also restricted to the
    batch's value range of that column, which Parquet partition pruning and
    row-group statistics turn into skipped files.
    """
    first = first_last_rows(batch, list(key), list(order_by), "first")
    if target is None:
        return first
    tgt = target
    if prune_on:
        tgt = in_batch_range(tgt, batch, prune_on)
    return anti_join(first, tgt, key)


def in_batch_range(target: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """The target's rows inside the batch's value range of ``column``, and those without a value.

    Two scalar subqueries over the raw batch (partial aggregation, one value
    each) become a range filter: on a partition column only the batch's
    partitions are read (all are listed), on another one Parquet statistics
    skip row groups."""
    lo = batch.agg(F.min(column)).scalar()
    hi = batch.agg(F.max(column)).scalar()
    return target.filter(F.col(column).isNull() | ((F.col(column) >= lo) & (F.col(column) <= hi)))


def anti_join(batch: DataFrame, target: DataFrame, key: Sequence[str] = CANDLE_KEY) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target``; NULLs of a key are equal."""
    known = target.select(*[F.col(c).alias(f"_known_{c}") for c in key])
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"_known_{c}"))
    return batch.join(known, same, "left_anti")


def high_water_marks(target: DataFrame, keys: Sequence[str] = ("symbol",),
                     column: str = "timestamp_ms") -> DataFrame:
    """A09 (all-series form): ``max(column)`` per key."""
    return target.groupBy(*keys).agg(F.max(column).alias("last_timestamp_ms"))


def high_water_mark(target: DataFrame, symbol: str, column: str = "timestamp_ms") -> DataFrame:
    """One row, ``max(column)`` of ``symbol``; NULL when the symbol is unknown."""
    return (target.filter(F.col("symbol") == F.lit(symbol))
            .agg(F.max(column).alias("last_timestamp_ms"))
            .select(F.lit(symbol).alias("symbol"), "last_timestamp_ms"))


def update_marks(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str] = ("symbol",),
                 column: str = "timestamp_ms") -> None:
    """Merge a batch's maxima into the stored marks: one row a series, a new version
    of the table each time. A maximum may be merged again, so a replay is harmless."""
    own = high_water_marks(batch, keys, column)
    old = read_marks(spark, path)
    version = 0
    if old is not None:
        version = int(spark.read.parquet(path).agg(F.max("version")).first()[0]) + 1
        own = own.unionByName(old).groupBy(*keys).agg(F.max("last_timestamp_ms").alias("last_timestamp_ms"))
    own.coalesce(1).write.parquet(f"{path}/version={version}")


def read_marks(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest marks (A09 without the history), or None before the first batch."""
    try:
        every = spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    newest = int(every.agg(F.max("version")).first()[0])
    return every.filter(F.col("version") == newest).drop("version")


def newer_than_marks(batch: DataFrame, marks: DataFrame | None, keys: Sequence[str] = ("symbol",),
                     column: str = "timestamp_ms") -> DataFrame:
    """Keep batch rows strictly newer than their series' mark (all rows of a
    series without one)."""
    if marks is None:
        return batch
    known = marks.select(*[F.col(k).alias(f"_mark_{k}") for k in keys], F.col("last_timestamp_ms").alias("_mark"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_mark_{k}"))
    return (batch.join(known, same, "left").filter(F.col("_mark").isNull() | (F.col(column) > F.col("_mark")))
            .select(*batch.columns))


def newer_than_last(batch: DataFrame, target: DataFrame, keys: Sequence[str] = ("symbol",),
                    column: str = "timestamp_ms") -> DataFrame:
    """S10 against the target's own rows, where no marks are kept: a scan of its
    key and time columns."""
    return newer_than_marks(batch, high_water_marks(target, keys, column), keys, column)
