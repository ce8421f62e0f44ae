"""Data-quality checks (Q01-Q06).

Each check is a DataFrame of failing rows (a test passes when it is empty).
The report (Q05) does not run one job per check: all ``not_null`` and
``accepted_values`` checks of one table fold into a single aggregation pass
of ``count_if`` expressions. Where the table is being written anyway they ride
on the write as ``observe`` metrics (``observed``, ``observed_report``) and read
nothing again. ``unique`` of dense whole numbers compares bitmaps with row counts,
so buckets of 32,768 ids are shuffled, not ids; the ids of unequal buckets alone
are grouped.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Ids of a bitmap bucket (fixed by Spark), and how many of them must be in use on
#: average for its 4 KB to be fewer than the ids' own 8 bytes each.
BUCKET_IDS, LEAST_IN_USE = 32_768, 512


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    """Q01: rows where ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def unique_failures(df: DataFrame, column: str, dense: bool | None = None) -> DataFrame:
    """Q02: values of ``column`` occurring more than once (NULLs ignored).

    ``dense`` says that a whole-number column fills its range well enough for
    bitmaps; by default one aggregation over the column decides. Task by task the
    bitmaps stay small if rows lie roughly in id order, as staged rows do.
    """
    known = df.filter(F.col(column).isNotNull())
    whole = isinstance(df.schema[column].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    if whole and dense is None:
        span = known.agg((F.max(column).cast("decimal(20,0)") - F.min(column).cast("decimal(20,0)")).alias("span"), F.count(F.lit(1)).alias("n")).first()
        dense = bool(span["n"]) and int(span["span"]) + 1 <= span["n"] * (BUCKET_IDS // LEAST_IN_USE)
    if whole and dense:
        known = known.join(repeated_buckets(known, column), F.bitmap_bucket_number(F.col(column).cast("long")) == F.col("_bucket"), "left_semi")
    return known.groupBy(column).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def repeated_buckets(df: DataFrame, column: str) -> DataFrame:
    """The id buckets that hold more rows than different ids."""
    value = F.col(column).cast("long")
    return (df.groupBy(F.bitmap_bucket_number(value).alias("_bucket"))
            .agg(F.count(F.lit(1)).alias("_rows"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(value))).alias("_ids"))
            .filter("_rows > _ids").select("_bucket"))


def accepted_values_failures(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Q03: rows whose non-NULL ``column`` is not in ``values``."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def negative_volume(df: DataFrame) -> DataFrame:
    """Q04: the singular test ``select date, symbol, volume where volume < 0``."""
    return df.filter(F.col("volume") < 0).select("date", "symbol", "volume")


@dataclass
class TableChecks:
    """The checks declared for one table."""
    table: str
    df: DataFrame
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted: dict = field(default_factory=dict)
    custom: dict = field(default_factory=dict)   # name -> failing-row predicate Column


def _failures_row(check: str, table: str, column: str | None, failures: Column) -> Column:
    return F.struct(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
                    F.lit(column).cast("string").alias("column_name"),
                    failures.cast("long").alias("failures"))


def _row_checks(t: TableChecks) -> list[tuple[str, str | None, Column]]:
    """(check, column, failing-row predicate) of the checks that look at one row at a time."""
    out = [("not_null", c, F.col(c).isNull()) for c in t.not_null]
    out += [("accepted_values", c, F.col(c).isNotNull() & ~F.col(c).isin(list(vals))) for c, vals in t.accepted.items()]
    return out + [(name, None, pred) for name, pred in t.custom.items()]


def _unique_rows(t: TableChecks) -> list[DataFrame]:
    return [unique_failures(t.df, c).agg(F.count(F.lit(1)).alias("n"))
            .select(_failures_row("unique", t.table, c, F.col("n")).alias("r")).select("r.*") for c in t.unique]


def _reported(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failures") == 0)


def check_report(tables: Sequence[TableChecks]) -> DataFrame:
    """Q05: one row per check: ``check_name, table_name, column_name, failures, passed``."""
    parts = []
    for t in tables:
        if rows := [_failures_row(name, t.table, c, F.count_if(bad)) for name, c, bad in _row_checks(t)]:
            parts.append(t.df.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*"))
        parts += _unique_rows(t)
    return _reported(parts)


@dataclass
class Observed:
    """Checks whose counts come with the next job that runs over ``df`` in full (its write)."""
    checks: TableChecks
    observation: Observation
    df: DataFrame


def observed(checks: TableChecks) -> Observed:
    """The table with its one-row checks counted as it passes by."""
    obs = Observation(f"checks_{checks.table}")
    counts = [F.count_if(bad).alias(f"c{i}") for i, (_, _, bad) in enumerate(_row_checks(checks))]
    return Observed(checks, obs, checks.df.observe(obs, F.count(F.lit(1)).alias("rows"), *counts))


def observed_report(spark: SparkSession, tables: Sequence[Observed], stored: Sequence[TableChecks] = ()) -> DataFrame:
    """Q05 after the writes: counts that came with them, and the ``unique`` checks
    of ``stored`` tables as queries. A stage that ran again after a lost executor
    may count a failing row twice; it never turns a failure into a pass."""
    rows = []
    for t in tables:
        found = t.observation.get
        rows += [(name, t.checks.table, c, int(found[f"c{i}"])) for i, (name, c, _) in enumerate(_row_checks(t.checks))]
    counted = spark.createDataFrame(rows, "check_name string, table_name string, column_name string, failures long")
    return _reported([counted, *[p for t in stored for p in _unique_rows(t)]])


def run_passed(report: DataFrame) -> DataFrame:
    """One row: does the whole run pass (every check has zero failures)?"""
    return report.agg(F.coalesce(F.min(F.col("passed").cast("int")), F.lit(1)).cast("boolean")
                      .alias("all_passed"), F.count_if(~F.col("passed")).alias("failed_checks"))


def freshness(staging: DataFrame, dead_letters: DataFrame | None, now: Column,
              max_age: str = "1 hour", reject_window: str = "5 minutes",
              ts: str = "ingested_at", dlq_ts: str = "timestamp") -> DataFrame:
    """Q06: two alert rules as checks.

    ``staging_stale``: no staging row ingested within ``max_age`` before
    ``now``; ``recent_rejects``: dead letters in the last ``reject_window``.
    """
    stale = staging.agg(
        F.when(F.max(ts).isNull() | (F.max(ts) < now - F.expr(f"INTERVAL {max_age}")), 1)
        .otherwise(0).cast("long").alias("failures"))
    parts = [stale.select(F.lit("staging_stale").alias("check_name"), "failures")]
    if dead_letters is not None:
        recent = dead_letters.agg(F.count_if(
            (F.col(dlq_ts) > now - F.expr(f"INTERVAL {reject_window}")) & (F.col(dlq_ts) <= now))
            .cast("long").alias("failures"))
        parts.append(recent.select(F.lit("recent_rejects").alias("check_name"), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failures") == 0)


def failed_runs(runs: DataFrame, now: Column, window: str = "5 minutes") -> DataFrame:
    """Q06: the alert on pipeline errors: runs that failed within ``window`` before
    ``now``, one row like those of :func:`freshness`. ``runs``: current run states."""
    recent = (F.col("status") == "failed") & (F.col("finished_at") > now - F.expr(f"INTERVAL {window}")) & (F.col("finished_at") <= now)
    return (runs.agg(F.count_if(recent).cast("long").alias("failures"))
            .select(F.lit("failed_runs").alias("check_name"), "failures").withColumn("passed", F.col("failures") == 0))
