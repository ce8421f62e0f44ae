"""Health counts and dashboard queries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.functions.signals import run_status_code
from barline.plans.quality import failed_runs
from barline.plans.runlog import current_runs

# The tables a health count may name.
COUNTABLE_TABLES = ("raw_ohlcv", "ohlcv_hourly", "ohlcv_daily", "technical_indicators",
                    "pipeline_runs")
HEALTH_TABLES = ("raw_ohlcv", "ohlcv_hourly", "ohlcv_daily", "technical_indicators")
LATEST_ROWS = 90
LATEST_RUNS = 10


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for an allow-listed set of tables.

    Unknown names raise ``ValueError`` (the allow-list guards the table name).
    Each count is its own aggregate (of a stored Parquet table: from file
    footers); the results are unioned, not collected.
    """
    parts = []
    for name, df in tables.items():
        if name not in COUNTABLE_TABLES:
            raise ValueError(f"Unknown table: {name}")
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(name).alias("table_name"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


HEALTH_ROW = "component string, table_name string, row_count long, status string, error string"


def health(spark: SparkSession, tables: Mapping[str, str | DataFrame], runs: DataFrame | None = None,
           now: Column | None = None, window: str = "5 minutes") -> DataFrame:
    """The health check: ``component, table_name, row_count, status, error``.

    ``tables`` are stored tables, by Parquet path or as read; a count reads file
    footers only. A table that cannot be read is ``down`` with its error, and so is
    the run log (``runs``: current states) if it cannot be read or a run failed
    within ``window`` before ``now``. The last row, ``overall``, is ``up`` only if
    every other one is. One job a table, of a fixed allow-list.
    """
    rows = []
    for name, table in tables.items():
        if name not in COUNTABLE_TABLES:
            raise ValueError(f"Unknown table: {name}")
        rows.append(_probe("storage", name, lambda t=table: (spark.read.parquet(t) if isinstance(t, str) else t).count()))
    if runs is not None:
        def no_failure():
            n = failed_runs(runs, F.current_timestamp() if now is None else now, window).first()["failures"]
            if n:
                raise RuntimeError(f"{n} failed runs")
            return runs.count()
        rows.append(_probe("runs", "pipeline_runs", no_failure))
    bad = sum(r[3] == "down" for r in rows)
    rows.append(("overall", None, None, "down" if bad else "up", f"{bad} of {len(rows)} components down" if bad else None))
    return spark.createDataFrame(rows, HEALTH_ROW)


def _probe(component: str, name: str, count) -> tuple:
    try:
        return component, name, int(count()), "up", None
    except Exception as exc:  # whatever keeps a table from being read is its health
        return component, name, None, "down", str(exc).splitlines()[0][:500]


def require_healthy(report: DataFrame) -> None:
    """Raise if the report's ``overall`` row is ``down`` (the health step of a run)."""
    bad = report.filter("status = 'down'").collect()
    if bad:
        raise RuntimeError("unhealthy: " + "; ".join(f"{r['table_name'] or r['component']}: {r['error']}" for r in bad))


def ingest_rate(raw: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """A10: rows per hour of ``ingested_at`` within ``hours`` before ``now``."""
    return (raw.filter(F.col("ingested_at") > now - F.expr(f"INTERVAL {hours} HOURS"))
            .groupBy(F.date_trunc("hour", "ingested_at").alias("time"))
            .agg(F.count(F.lit(1)).alias("rows_ingested")).orderBy("time"))


def message_throughput(envelope: DataFrame, minutes: int = 5) -> DataFrame:
    """Messages per ``minutes`` window and partition, and the per-second rate."""
    w = F.window("timestamp", f"{minutes} minutes")
    return (envelope.groupBy(w.alias("w"), "partition").agg(F.count(F.lit(1)).alias("messages"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "partition", "messages",
                    (F.col("messages") / F.lit(minutes * 60.0)).alias("messages_per_sec")))


def dead_letter_counts(dlq: DataFrame) -> DataFrame:
    """Dead letters per reason."""
    return dlq.groupBy("error_reason", "reason_detail").agg(F.count(F.lit(1)).alias("messages"))


def symbol_rows(df: DataFrame, symbol: str) -> DataFrame:
    """P10: ``symbol = ?``."""
    return df.filter(F.col("symbol") == F.lit(symbol))


def within_hours(df: DataFrame, column: str, now: Column, hours: int = 24) -> DataFrame:
    """P10: ``column > now - hours``; ``now`` is a parameter so results are testable."""
    return df.filter(F.col(column) > now - F.expr(f"INTERVAL {hours} HOURS"))


def latest_closes(daily: DataFrame, symbol: str, n: int = LATEST_ROWS) -> DataFrame:
    """Latest ``n`` daily closes of a symbol (exchange breaks date ties)."""
    return (symbol_rows(daily, symbol)
            .orderBy(F.col("date").desc(), F.col("exchange").asc()).limit(n)
            .select(F.col("date").alias("time"), "exchange", "close"))


def latest_moving_averages(ind: DataFrame, symbol: str, n: int = LATEST_ROWS) -> DataFrame:
    """K02."""
    return (symbol_rows(ind, symbol).orderBy(F.col("date").desc()).limit(n)
            .select(F.col("date").alias("time"), "sma_7", "sma_25", "ema_12", "ema_26"))


def latest_rsi(ind: DataFrame, symbol: str, n: int = LATEST_ROWS) -> DataFrame:
    """K03."""
    return (symbol_rows(ind, symbol).orderBy(F.col("date").desc()).limit(n)
            .select(F.col("date").alias("time"), "rsi_14"))


def latest_runs(runs: DataFrame, n: int = LATEST_RUNS) -> DataFrame:
    """K04 + P09: latest ``n`` runs by start time with the status code."""
    return (runs.orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(n)
            .select(F.col("started_at").alias("time"), "run_id",
                    run_status_code().alias("status")))


def panels(spark: SparkSession, out_dir: str, symbol: str) -> dict[str, DataFrame]:
    """K01-K04 over the tables that a run stored under ``out_dir``: scans of a few
    columns, filtered by symbol in the scan, and a top-90."""
    read = lambda name: spark.read.parquet(f"{out_dir}/{name}")
    ind = read("technical_indicators")
    return {"closes": latest_closes(read("ohlcv_daily"), symbol), "moving_averages": latest_moving_averages(ind, symbol),
            "rsi": latest_rsi(ind, symbol), "runs": latest_runs(current_runs(read("pipeline_runs")))}
