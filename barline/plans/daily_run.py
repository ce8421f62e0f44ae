"""The daily run (R03): candles -> indicators -> marts -> checks -> health.

A plain function calling the stages in order; every stage is a Spark job that
writes a table into ``out_dir`` (a shared folder), so each stage reads its
input back from storage instead of recomputing a long lineage, and a lost
executor costs one stage, not the run. Row counts come from ``observe`` on
the writes (no extra ``count()`` jobs). Start and end are appended to the run
log; a failure records ``failed`` with its message and re-raises.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barline.operators.candles import candle_state, candles_of, int_ohlcv_daily, merge_states
from barline.operators.indicators import compute_all_indicators
from barline.operators.marts import dim_trading_pairs, fct_market_daily
from barline.operators.staging import stg_raw_ohlcv
from barline.plans.monitoring import table_counts
from barline.plans.quality import TableChecks, observed, observed_report, run_passed
from barline.plans.runlog import current_runs, single_event
from barline.functions.signals import BAND_POSITIONS, RSI_SIGNALS
from barline.sources.tables import by_partition


def _write(df: DataFrame, path: str, name: str, partition_by: Sequence[str] = (),
           sort_by: Sequence[str] = ()) -> int:
    """Replace the whole table at ``path``, whatever the session's overwrite mode."""
    obs = Observation(name)
    if partition_by:
        df = by_partition(df, partition_by)
    if sort_by:   # clustered files: row-group min/max statistics then prune reads
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite") \
        .option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return int(obs.get["rows"])


def daily_run(spark: SparkSession, raw: DataFrame, out_dir: str, run_id: str,
              dag_id: str = "candles_daily", order_by: Sequence[str] = ("timestamp_ms", "id"),
              series: Sequence[str] = ("symbol", "exchange"), extra: Sequence[str] = (),
              order_bits: dict | None = None, raw_grain: str = "month",
              fail_on_checks: bool = False,
              clock=lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)) -> DataFrame:
    """Run every stage over ``raw``; returns ``(table_name, row_count)`` of the outputs.

    ``raw`` is the whole raw table, not an increment: every output is replaced
    (:mod:`barline.plans.incremental_run` updates the touched dates of a staging table).
    With ``fail_on_checks`` a failed data-quality check fails the run (it is
    recorded as ``failed`` with the number of failed checks); otherwise the
    check report is written and the run succeeds.
    """
    runs_path = f"{out_dir}/pipeline_runs"
    single_event(spark, dag_id, run_id, "running", clock(), started=True) \
        .write.mode("append").parquet(runs_path)
    try:
        if raw.isEmpty():                      # empty input stops early
            rows = 0
        else:
            # The raw table is stored by period (``raw_grain``: day, month or
            # year) and clustered by series and time inside each file, so time
            # predicates prune directories and symbol/time predicates prune row
            # groups. Pick the grain so one directory holds at least a few
            # hundred MB.
            period = F.date_trunc(raw_grain, F.timestamp_millis("timestamp_ms")).cast("date")
            dated = raw.withColumn("candle_period", period)
            rows = _write(dated, f"{out_dir}/raw_ohlcv", "raw", ("candle_period",),
                          ("symbol", "timestamp_ms"))
            stored = spark.read.parquet(f"{out_dir}/raw_ohlcv").drop("candle_period")
            # raw rows are rolled up once; days come from the hourly states
            _write(candle_state(stored, "hour", order_by, order_bits=order_bits), f"{out_dir}/candle_state", "state")
            state = spark.read.parquet(f"{out_dir}/candle_state")
            _write(candles_of(state), f"{out_dir}/ohlcv_hourly", "hourly")
            _write(candles_of(merge_states(state)), f"{out_dir}/ohlcv_daily", "daily")
            daily = spark.read.parquet(f"{out_dir}/ohlcv_daily")
            _write(compute_all_indicators(daily, partition_by=series),
                   f"{out_dir}/technical_indicators", "indicators")
            ind = spark.read.parquet(f"{out_dir}/technical_indicators")
            staged = stg_raw_ohlcv(stored, extra=extra)
            # one-row checks are counted as the tables are written; ``unique`` alone is a query
            seen = [observed(TableChecks("stg_raw_ohlcv", staged, not_null=("id", "symbol", "timestamp_ms", "volume")))]
            seen.append(observed(TableChecks("int_ohlcv_daily", int_ohlcv_daily(seen[0].df, order_by, order_bits),
                                             not_null=("symbol", "date", "volume"))))
            _write(seen[1].df, f"{out_dir}/int_ohlcv_daily", "int")
            inter = spark.read.parquet(f"{out_dir}/int_ohlcv_daily")
            keys = ("symbol", "exchange", "date") if "exchange" in series else ("symbol", "date")
            seen.append(observed(TableChecks("fct_market_daily", fct_market_daily(inter, ind, keys), not_null=("symbol", "date", "close"),
                                             accepted={"rsi_signal": RSI_SIGNALS, "bb_position": BAND_POSITIONS},
                                             custom={"assert_positive_volume": F.col("volume") < 0})))
            _write(seen[2].df, f"{out_dir}/fct_market_daily", "fct")
            _write(dim_trading_pairs(inter), f"{out_dir}/dim_trading_pairs", "dim")
            report = observed_report(spark, seen, [TableChecks("stg_raw_ohlcv", staged, unique=("id",))])
            _write(report, f"{out_dir}/check_report", "report")
            if fail_on_checks:
                verdict = run_passed(spark.read.parquet(f"{out_dir}/check_report")).first()
                if not verdict["all_passed"]:   # one row: the verdict, not the data
                    raise RuntimeError(f"{verdict['failed_checks']} data-quality checks failed")
    except Exception as exc:
        single_event(spark, dag_id, run_id, "failed", clock(), 0, str(exc)) \
            .write.mode("append").parquet(runs_path)
        raise
    single_event(spark, dag_id, run_id, "success", clock(), rows) \
        .write.mode("append").parquet(runs_path)
    names = ("raw_ohlcv", "ohlcv_hourly", "ohlcv_daily", "technical_indicators")
    tables = {n: spark.read.parquet(f"{out_dir}/{n}") for n in names} if rows else {}
    tables["pipeline_runs"] = current_runs(spark.read.parquet(runs_path))
    return table_counts(tables)
