"""Run log (R01, R02): an append-only table of run events.

Instead of updating a row in place, the start (R01) and the end (R02) of a
run are two appended events; the current state of every run is the latest
event per ``run_id`` (``max_by`` over the event time: a partial aggregation,
no sort). Append-only writes are safe to retry and need no transactions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.schemas import PIPELINE_RUN_EVENT


def start_events(runs: DataFrame, dag_id: Column | str, run_id: str = "run_id",
                 started_at: str = "started_at") -> DataFrame:
    """One ``running`` event per run."""
    d = F.lit(dag_id) if isinstance(dag_id, str) else dag_id
    return runs.select(
        d.alias("dag_id"), F.col(run_id).alias("run_id"), F.lit("running").alias("status"),
        F.col(started_at).cast("timestamp").alias("event_at"),
        F.col(started_at).cast("timestamp").alias("started_at"),
        F.lit(None).cast("timestamp").alias("finished_at"),
        F.lit(0).cast("long").alias("rows_processed"),
        F.lit(None).cast("string").alias("error_message"))


def end_events(runs: DataFrame, dag_id: Column | str, status: str = "status",
               finished_at: str = "finished_at", rows_processed: str = "rows_processed",
               error_message: str | None = "error_message", run_id: str = "run_id") -> DataFrame:
    """The final status, finish time, row count and error message."""
    d = F.lit(dag_id) if isinstance(dag_id, str) else dag_id
    err = F.col(error_message) if error_message else F.lit(None)
    return runs.select(
        d.alias("dag_id"), F.col(run_id).alias("run_id"), F.col(status).alias("status"),
        F.col(finished_at).cast("timestamp").alias("event_at"),
        F.lit(None).cast("timestamp").alias("started_at"),
        F.col(finished_at).cast("timestamp").alias("finished_at"),
        F.col(rows_processed).cast("long").alias("rows_processed"),
        err.cast("string").alias("error_message"))


def single_event(spark: SparkSession, dag_id: str, run_id: str, status: str, event_at,
                 rows_processed: int = 0, error_message: str | None = None,
                 started: bool = False) -> DataFrame:
    """One event row built on the driver (the orchestrator's own record)."""
    row = (dag_id, run_id, status, event_at, event_at if started else None,
           None if started else event_at, rows_processed, error_message)
    return spark.createDataFrame([row], PIPELINE_RUN_EVENT)


def current_runs(events: DataFrame) -> DataFrame:
    """Latest state per run: status, times, rows and error of the last event,
    ``started_at`` from the start event."""
    last = F.max_by(F.struct("status", "finished_at", "rows_processed", "error_message"),
                    F.struct("event_at", F.when(F.col("status") == "running", 0).otherwise(1)))
    return (events.groupBy("dag_id", "run_id")
            .agg(F.min("started_at").alias("started_at"), last.alias("s"))
            .select("dag_id", "run_id", "s.status", "started_at", "s.finished_at",
                    "s.rows_processed", "s.error_message"))
