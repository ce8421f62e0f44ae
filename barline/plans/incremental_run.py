"""The daily run on the ingest's own table (R03), touched dates only.

The staging table's manifest says which candle dates got rows since the last
run's mark (:meth:`FileTable.touched_since`): late rows too, whatever time they
carry, and nothing that was committed late is missed. A run then

1. opens the raw files of these dates, where they are, and writes their hourly
   candle states;
2. makes hourly and daily candles from the stored states, without raw rows, and the
   staged daily candles from the same files;
3. continues the indicators from the stored series state and rewrites the fact table
   from the first touched date on;
4. rebuilds the pair statistics from the daily table, runs the checks, and stores
   the mark last: a run that fails before is done again whole.

Every table is partitioned by date and replaced by partition, so a run that is
repeated changes nothing. One-row checks ride on the writes (``observe``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.functions.signals import BAND_POSITIONS, RSI_SIGNALS
from barline.operators.candles import DEFAULT_ORDER, candle_state, candles_of, int_ohlcv_daily, merge_states
from barline.operators.marts import dim_trading_pairs, fct_market_daily
from barline.operators.resume import continue_indicators, last_rows, state_before
from barline.operators.staging import stg_raw_ohlcv
from barline.plans.monitoring import health, table_counts
from barline.plans.quality import TableChecks, observed, observed_report, run_passed
from barline.plans.runlog import current_runs, single_event
from barline.schemas import INDICATOR_COLUMNS
from barline.session import discard, stored
from barline.sources.tables import write_table
from barline.streaming.manifest import FileTable, read_if_any

PART = "candle_date"
MARK_SCHEMA = "run_id string, mark long, last_date date, state_path string"


@dataclass
class RunResult:
    """What a run did: dates it recomputed, raw files it opened, rows it read, and the counts of all tables."""
    dates: list[str]
    opened: list[str]
    rows: int
    counts: DataFrame


def _write(df: DataFrame, path: str, date: str) -> None:
    write_table(df.withColumn(PART, F.to_date(F.col(date))), path, mode="overwrite", partition_by=[PART])


def read_dates(spark: SparkSession, path: str, where: str | None = None) -> DataFrame | None:
    """A date-partitioned table, pruned by a predicate on ``candle_date``."""
    df = read_if_any(spark, path)
    if df is None:
        return None
    return (df.filter(where) if where else df).drop(PART)


def _quoted(dates: Sequence[str]) -> str:
    return ", ".join(f"DATE'{d}'" for d in dates)


def incremental_run(spark: SparkSession, staging: FileTable, out_dir: str, run_id: str,
                    dag_id: str = "candles_incremental", series: Sequence[str] = ("symbol",),
                    order_by: Sequence[str] = DEFAULT_ORDER, extra: Sequence[str] = (),
                    order_bits: Mapping[str, int] | None = None, fail_on_checks: bool = False,
                    clock: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)) -> RunResult:
    """Bring the tables under ``out_dir`` up to date with ``staging``.

    With ``fail_on_checks`` a failed check fails the run; it is recorded, and the
    same dates are done again by the next run.
    """
    runs_path = f"{out_dir}/pipeline_runs"
    single_event(spark, dag_id, run_id, "running", clock(), started=True).write.mode("append").parquet(runs_path)
    try:
        marks = read_if_any(spark, f"{out_dir}/run_marks", MARK_SCHEMA)
        last = marks.orderBy(F.desc("mark")).first() if marks is not None else None
        mark = staging.commits
        dates = staging.touched_since(last["mark"] if last else 0)
        entries = staging.entries(dates)
        rows = sum(e.rows for e in entries)
        if dates:
            _update(spark, staging, entries, dates, out_dir, run_id, mark, last, series, order_by, extra, order_bits, fail_on_checks)
    except Exception as exc:
        single_event(spark, dag_id, run_id, "failed", clock(), 0, str(exc)).write.mode("append").parquet(runs_path)
        raise
    single_event(spark, dag_id, run_id, "success", clock(), rows).write.mode("append").parquet(runs_path)
    return RunResult(dates, [e.file for e in entries], rows, counts(spark, staging, out_dir))


def _update(spark, staging, entries, dates, out_dir, run_id, mark, last, series, order_by, extra, order_bits, fail_on_checks) -> None:
    at = lambda name: f"{out_dir}/{name}"
    touched, onward = f"{PART} IN ({_quoted(dates)})", f"{PART} >= DATE'{dates[0]}'"
    raw = staging.read(entries).drop(PART)
    _write(candle_state(raw, "hour", order_by, order_bits=order_bits), at("candle_state"), "hour_start")
    state = read_dates(spark, at("candle_state"), touched)
    _write(candles_of(state), at("ohlcv_hourly"), "hour_start")
    _write(candles_of(merge_states(state)), at("ohlcv_daily"), "date")

    staged = stg_raw_ohlcv(raw, extra=extra)
    seen = [observed(TableChecks("stg_raw_ohlcv", staged, not_null=("id", "symbol", "timestamp_ms", "volume")))]
    seen.append(observed(TableChecks("int_ohlcv_daily", int_ohlcv_daily(seen[0].df, order_by, order_bits), not_null=("symbol", "date", "volume"))))
    _write(seen[1].df, at("int_ohlcv_daily"), "date")

    # late rows lie before the stored state: take it from the tables as of their date
    new = read_dates(spark, at("ohlcv_daily"), onward)
    if last is None:
        known = None
    elif str(last["last_date"]) < dates[0]:
        known = spark.read.parquet(last["state_path"])
    else:
        before = f"{PART} < DATE'{dates[0]}'"
        known = state_before(read_dates(spark, at("ohlcv_daily"), before), read_dates(spark, at("technical_indicators"), before), dates[0], series)
    made = stored(continue_indicators(new, known, series), "indicators")
    _write(made.filter("is_new").select(*series, "date", *INDICATOR_COLUMNS), at("technical_indicators"), "date")
    state_path = f"{at('series_state')}/{run_id}-{mark}"
    last_rows(made, series).write.mode("overwrite").parquet(state_path)
    discard(made)

    keys = (*series, "date")
    inter, ind = read_dates(spark, at("int_ohlcv_daily"), onward), read_dates(spark, at("technical_indicators"), onward)
    seen.append(observed(TableChecks("fct_market_daily", fct_market_daily(inter, ind, keys), not_null=("symbol", "date", "close"),
                                     accepted={"rsi_signal": RSI_SIGNALS, "bb_position": BAND_POSITIONS},
                                     custom={"assert_positive_volume": F.col("volume") < 0})))
    _write(seen[2].df, at("fct_market_daily"), "date")
    dim_trading_pairs(read_dates(spark, at("int_ohlcv_daily"))).write.mode("overwrite").parquet(at("dim_trading_pairs"))

    report = observed_report(spark, seen, [TableChecks("stg_raw_ohlcv", staged, unique=("id",))])
    report.write.mode("overwrite").parquet(at("check_report"))
    if fail_on_checks:
        verdict = run_passed(spark.read.parquet(at("check_report"))).first()
        if not verdict["all_passed"]:
            raise RuntimeError(f"{verdict['failed_checks']} data-quality checks failed")
    newest = max(dates[-1], str(last["last_date"])) if last else dates[-1]
    spark.createDataFrame([(run_id, mark, dt.date.fromisoformat(newest), state_path)], MARK_SCHEMA) \
        .coalesce(1).write.mode("append").parquet(at("run_marks"))


def counts(spark: SparkSession, staging: FileTable, out_dir: str) -> DataFrame:
    """A08 of the stored tables: raw rows from the manifest, the others from Parquet footers."""
    raw = spark.createDataFrame([("raw_ohlcv", staging.row_count())], "table_name string, row_count long")
    tables = {n: df for n in ("ohlcv_hourly", "ohlcv_daily", "technical_indicators") if (df := read_if_any(spark, f"{out_dir}/{n}")) is not None}
    tables["pipeline_runs"] = current_runs(spark.read.parquet(f"{out_dir}/pipeline_runs"))
    return raw.unionByName(table_counts(tables))


def run_health(spark: SparkSession, out_dir: str, now=None) -> DataFrame:
    """The health step of a run: its tables and its run log."""
    runs = read_if_any(spark, f"{out_dir}/pipeline_runs")
    paths = {n: f"{out_dir}/{n}" for n in ("ohlcv_hourly", "ohlcv_daily", "technical_indicators")}
    return health(spark, paths, None if runs is None else current_runs(runs), now)
