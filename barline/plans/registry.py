"""Named queries, one per operator ID of the inventory.

Each entry takes ``(spark, sf_dir)``, reads the driver's test tables (through
the candle views of :mod:`barline.sources.candle_views`) and returns a
DataFrame. Floating outputs are snapped to a binary grid of 2^-20 *here only*, so that the
comparison with an independent SQL engine does not depend on the order of
floating-point additions; the library functions themselves return full
precision.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import StreamingQueryException

from barline.functions import series as SR
from barline.functions.signals import BAND_POSITIONS, RSI_SIGNALS, run_status_code
from barline.operators import candles as C
from barline.operators import dedupe as D
from barline.operators import indicators as IND
from barline.operators import marts as M
from barline.operators import staging as S
from barline.operators.ema import with_emas
from barline.plans import monitoring as MON
from barline.plans import quality as Q
from barline.plans import runlog as RL
from barline.sources import candle_views as V
from barline.sources import messages as MSG
from barline.sources.candle_views import E_ORDER, L_BITS, L_ORDER, raw_e, raw_l
from barline.sources.tables import read_table, write_table
from barline.streaming import ingest as ING

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TARGET_BEFORE_E = "2024-01-20"      # yesterday's table vs today's rows (S10, incremental A02)


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


GRID = float(2 ** 20)


def snap(c: str, grid: float = GRID):
    """Snap a double to a binary grid of 2^-20 (about 1e-6); -0.0 becomes 0.0."""
    return F.round(F.col(c) * F.lit(grid)) / F.lit(grid) + F.lit(0.0)


def rounded(df: DataFrame, grid: float = GRID) -> DataFrame:
    return df.select(*[snap(f.name, grid).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


# ---------------------------------------------------------------- candles
@query("a01_hourly_candles")
def a01(spark, sf):
    return rounded(C.hourly_candles(raw_e(spark, sf), E_ORDER))


@query("a02_daily_candles")
def a02(spark, sf):
    return rounded(C.daily_candles(raw_e(spark, sf), E_ORDER))


@query("a02_daily_candles_long")
def a02l(spark, sf):
    return rounded(C.daily_candles(raw_l(spark, sf), L_ORDER, L_BITS))


@query("a02_daily_candles_incremental")
def a02i(spark, sf):
    """A02 kept up to date by two incremental refreshes (first days, then the
    dates touched by rows ingested later); equals the full recomputation."""
    from barline.plans.refresh import read_candles, refresh_candles
    from barline.session import work_path
    path = work_path(spark, "ohlcv_daily")
    raw = raw_e(spark, sf)
    cut = F.to_timestamp(F.lit(TARGET_BEFORE_E))
    refresh_candles(raw.filter(F.col("ingested_at") < cut), path, "day", None, E_ORDER)
    refresh_candles(raw, path, "day", cut - F.expr("INTERVAL 12 HOURS"), E_ORDER)
    return rounded(read_candles(spark, path))


@query("a02_daily_from_hourly_state")
def a02s(spark, sf):
    """A02 without the raw rows: hourly states, stored, merged into days."""
    from barline.session import stored
    hourly = stored(C.candle_state(raw_e(spark, sf), "hour", E_ORDER), "candle_state")
    return rounded(C.candles_of(C.merge_states(hourly)))


@query("a03_vwap")
def a03(spark, sf):
    h = C.hourly_candles(raw_e(spark, sf), E_ORDER)
    return rounded(h.select("symbol", "exchange", "hour_start", "volume", "vwap"))


@query("a04_first_last_value")
def a04(spark, sf):
    raw = raw_l(spark, sf)
    month = F.date_trunc("month", F.timestamp_millis("timestamp_ms")).alias("month")
    raw = raw.select("*", C.order_key(raw, L_ORDER, L_BITS).alias("_ord"))
    return rounded(raw.groupBy("symbol", month).agg(
        C.first_value("open", F.col("_ord")).alias("first_open"),
        C.last_value("close", F.col("_ord")).alias("last_close")))


def staged_e(spark, sf):
    return S.stg_raw_ohlcv(raw_e(spark, sf))


@query("a05_int_ohlcv_daily")
def a05(spark, sf):
    return rounded(C.int_ohlcv_daily(staged_e(spark, sf), E_ORDER))


@query("j01_candles_rank_join")
def j01(spark, sf):
    return rounded(C.candles_rank_join(raw_e(spark, sf), "hour", E_ORDER))


@query("w12_first_last_rows")
def w12(spark, sf):
    raw = raw_e(spark, sf).withColumn("date", F.to_date(F.timestamp_millis("timestamp_ms")))
    keys = ["symbol", "exchange", "date"]
    first = C.first_last_rows(raw, keys, E_ORDER, "first").withColumn("which", F.lit("first"))
    last = C.first_last_rows(raw, keys, E_ORDER, "last").withColumn("which", F.lit("last"))
    return rounded(first.unionByName(last).select("which", "symbol", "exchange", "date", "id",
                                                  "open", "close"))


@query("f01_f06_time_functions")
def f01(spark, sf):
    """Epoch ms -> exact and whole-second timestamps, hour, date, ISO text."""
    from barline.functions import timecols as TC
    raw = raw_e(spark, sf)
    exact = TC.candle_time_exact("timestamp_ms")
    return raw.select(
        "id", "timestamp_ms", exact.alias("ts_exact"),
        TC.candle_time_seconds("timestamp_ms").alias("ts_seconds"),
        TC.ms_to_hour("timestamp_ms").alias("hour_start"), TC.ms_to_date("timestamp_ms").alias("date"),
        F.date_format(exact, "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'").alias("iso"))


@query("f07_f12_scalar_functions")
def f07(spark, sf):
    """Arithmetic, greatest, sqrt, nullif/coalesce/CASE, key concat,
    JSON decode of ``events.props``, array element access, casts."""
    ev = V.read_test_table(spark, sf, "events")
    raw = V.candles_from_events(ev, keep=("props",))
    arr = F.array("open", "high", "low", "close")
    return rounded(raw.select(
        "id",
        F.abs(F.col("close") - F.col("open")).alias("abs_move"),
        F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - F.col("close"))).alias("range_max"),
        F.sqrt(F.abs("volume")).alias("sqrt_volume"),
        (-F.col("volume")).alias("neg_volume"),
        (F.col("close") / F.nullif(F.col("open"), F.lit(0.0))).alias("close_over_open"),
        F.coalesce(F.nullif(F.col("open"), F.lit(0.0)), F.col("close")).alias("open_or_close"),
        F.when(F.col("close") >= F.col("open"), "up").otherwise("down").alias("direction"),
        F.concat_ws(":", "symbol", F.col("timestamp_ms").cast("string")).alias("msg_key"),
        F.from_json("props", "struct<k:bigint>")["k"].alias("prop_k"),
        F.element_at(arr, 1).alias("first_price"), arr[3].alias("last_price"),
        F.col("volume").cast("long").alias("volume_long"),
        F.col("ingested_at").cast("date").alias("ingest_date")))


# ---------------------------------------------------------------- staging
@query("p01_time_columns")
def p01(spark, sf):
    return S.with_time_columns(raw_e(spark, sf)).select(
        "id", "timestamp_ms", "candle_time", "hour_bucket", "date_bucket")


@query("p02_quality_flags")
def p02(spark, sf):
    return S.with_quality_flags(raw_e(spark, sf)).select("id", *S.QUALITY_FLAGS)


@query("p03_quality_filter")
def p03(spark, sf):
    return rounded(S.passing_quality(S.with_quality_flags(raw_e(spark, sf)))
                   .select("id", "symbol", "exchange", "timestamp_ms", "open", "high", "low",
                           "close", "volume"))


@query("p04_stg_raw_ohlcv")
def p04(spark, sf):
    return rounded(S.register_staging_view(raw_e(spark, sf), "stg_raw_ohlcv"))


@query("p05_select_rename")
def p05(spark, sf):
    return rounded(S.select_columns(raw_e(spark, sf), ["id", "symbol", "open", "close"],
                                    {"open": "open_price", "close": "close_price"}))


# ---------------------------------------------------------------- indicators

LONG_SYMBOL = "A/F"     # the series the dashboard queries read (K01-K03)


def daily_l(spark, sf):
    """Daily candles of view L (one exchange, six long daily series), stored
    as a table as the daily job does: the indicator branches re-scan it."""
    from barline.session import stored
    return stored(C.daily_candles(raw_l(spark, sf), L_ORDER, L_BITS), "ohlcv_daily_l")


def indicators_l(spark, sf):
    return IND.compute_all_indicators(daily_l(spark, sf))


def stored_indicators_l(spark, sf):
    """The indicator table, written as a run does: the panels scan it."""
    from barline.session import stored
    return stored(indicators_l(spark, sf), "technical_indicators")


@query("w01_sma")
def w01(spark, sf):
    s = IND.Series()
    return rounded(daily_l(spark, sf).select(
        "symbol", "date", *[IND.sma_col(s, "close", n).alias(f"sma_{n}") for n in (7, 25, 99)]))


@query("w02_sma_macro")
def w02(spark, sf):
    d = C.daily_candles(raw_e(spark, sf), E_ORDER)
    return rounded(d.select("symbol", "exchange", "date",
                            SR.sma("close", 5, ("symbol", "exchange"), "date").alias("sma_5")))


@query("w02_w13_macros_split_series")
def w02s(spark, sf):
    """W02-W04/W13 over intraday rows (one candle per event) of each
    (symbol, exchange) series, with series cut into buckets plus a halo so no
    task holds a whole series; buckets of 256 rows, scaled to the test data."""
    from barline.operators.series_blocks import bounded_lookback, macro_columns
    raw = raw_e(spark, sf)
    lookback, cols = macro_columns("close", sma_periods=(5,), std_periods=(20,), lags=(1,),
                                   pct_periods=(1,))
    out = bounded_lookback(raw, ("symbol", "exchange"), ("timestamp_ms", "id"), lookback, cols, bucket_rows=256)
    return rounded(out.select("id", "symbol", "exchange", "sma_5", "std_20", "close_lag_1", "pct_1"))


@query("w03_pct_change")
def w03(spark, sf):
    return rounded(daily_l(spark, sf).select(
        "symbol", "date", SR.pct_change("close", 1).alias("pct_1"),
        SR.pct_change("close", 7).alias("pct_7")))


@query("w04_rolling_std")
def w04(spark, sf):
    return rounded(daily_l(spark, sf).select(
        "symbol", "date", SR.rolling_std("close", 20).alias("std_20")))


@query("w05_ema")
def w05(spark, sf):
    d = daily_l(spark, sf).select("symbol", "date", "close")
    return rounded(with_emas(d, "close", [12, 26]))


@query("w06_rsi")
def w06(spark, sf):
    return rounded(IND.compute_rsi(daily_l(spark, sf)).select("symbol", "date", "rsi_14"))


@query("w07_macd")
def w07(spark, sf):
    return rounded(indicators_l(spark, sf).select("symbol", "date", "macd", "macd_signal",
                                                  "macd_histogram"))


@query("w08_bollinger")
def w08(spark, sf):
    return rounded(IND.compute_bollinger_bands(daily_l(spark, sf))
                   .select("symbol", "date", "bb_upper", "bb_middle", "bb_lower"))


@query("w09_atr")
def w09(spark, sf):
    return rounded(IND.compute_atr(daily_l(spark, sf)).select("symbol", "date", "atr_14"))


@query("w10_obv")
def w10(spark, sf):
    return rounded(IND.compute_obv(daily_l(spark, sf)).select("symbol", "date", "obv"))


@query("w11_all_indicators")
def w11(spark, sf):
    return rounded(indicators_l(spark, sf))


@query("w11_all_indicators_split_series")
def w11s(spark, sf):
    """W11 with no whole-series step (buckets of 256 rows plus halo, split
    row index and OBV running sum): the form for series too large for a task."""
    return rounded(IND.compute_all_indicators(daily_l(spark, sf), split=True, bucket_rows=256))


@query("w11_indicators_resumed")
def w11r(spark, sf):
    """W11 in three runs, each from the state that the one before stored. Snapped to
    2^-10: the last digits of an EMA depend on where its series was cut."""
    from barline.operators.resume import continue_indicators, last_rows
    from barline.session import stored
    daily, state, parts = daily_l(spark, sf), None, []
    for low, high in (("0001-01-01", "1994-07-01"), ("1994-07-01", "1997-02-01"), ("1997-02-01", "9999-12-31")):
        new = daily.filter(F.col("date").between(F.lit(low).cast("date"), F.date_sub(F.lit(high).cast("date"), 1)))
        made = stored(continue_indicators(new, state), "resumed")
        state = stored(last_rows(made), "series_state")
        parts.append(made.filter("is_new"))
    out = parts[0].union(parts[1]).union(parts[2])
    return rounded(out.select("symbol", "date", *IND.INDICATOR_COLUMNS), float(2 ** 10))


@query("w13_lag")
def w13(spark, sf):
    return rounded(daily_l(spark, sf).select(
        "symbol", "date", "close", SR.lag_col("close", 1).alias("close_lag_1"),
        SR.lag_col("close", 5).alias("close_lag_5")))


# ---------------------------------------------------------------- marts
def int_daily_l(spark, sf):
    return C.int_ohlcv_daily(S.stg_raw_ohlcv(raw_l(spark, sf), extra=("line", "part")), L_ORDER, L_BITS)


def fct_l(spark, sf):
    return M.fct_market_daily(int_daily_l(spark, sf), indicators_l(spark, sf))


@query("m01_fct_market_daily")
def m01(spark, sf):
    return rounded(fct_l(spark, sf))


@query("m01_fct_market_daily_by_exchange")
def m01x(spark, sf):
    """X1 resolved: series per (symbol, exchange) and the join on both."""
    ind = IND.compute_all_indicators(C.daily_candles(raw_e(spark, sf), E_ORDER),
                                     partition_by=("symbol", "exchange"))
    return rounded(M.fct_market_daily(C.int_ohlcv_daily(staged_e(spark, sf), E_ORDER), ind,
                                      ("symbol", "exchange", "date")))


@query("j02_daily_left_join_indicators")
def j02(spark, sf):
    j = M.join_indicators(int_daily_l(spark, sf), indicators_l(spark, sf))
    return rounded(j.select("symbol", "date", "close", "sma_7", "ema_12", "rsi_14", "obv"))


@query("p06_rsi_signal")
def p06(spark, sf):
    return rounded(fct_l(spark, sf).select("symbol", "date", "rsi_14", "rsi_signal"))


@query("p07_macd_direction")
def p07(spark, sf):
    return fct_l(spark, sf).select("symbol", "date", "macd_signal_direction")


@query("p08_band_position")
def p08(spark, sf):
    return fct_l(spark, sf).select("symbol", "date", "bb_position")


@query("a06_pair_stats")
def a06(spark, sf):
    return rounded(M.pair_stats(C.int_ohlcv_daily(staged_e(spark, sf), E_ORDER)))


@query("a07_risk_ratios")
def a07(spark, sf):
    d = M.dim_trading_pairs(C.int_ohlcv_daily(staged_e(spark, sf), E_ORDER))
    return rounded(d.select("symbol", "exchange", "annualized_volatility", "sharpe_ratio"))


@query("m02_dim_trading_pairs")
def m02(spark, sf):
    return rounded(M.dim_trading_pairs(C.int_ohlcv_daily(staged_e(spark, sf), E_ORDER)))


@query("m02_dim_trading_pairs_long")
def m02l(spark, sf):
    return rounded(M.dim_trading_pairs(int_daily_l(spark, sf)))


# ---------------------------------------------------------------- quality

NOW = "2024-01-30 12:00:00"   # the dashboards' "now", fixed so results are testable


def now_col():
    return F.to_timestamp(F.lit(NOW))


def staged_faulty(spark, sf):
    return S.stg_raw_ohlcv(V.with_key_faults(raw_e(spark, sf)))


@query("q01_not_null")
def q01(spark, sf):
    return Q.not_null_failures(staged_faulty(spark, sf), "symbol").select("id", "timestamp_ms")


@query("q02_unique")
def q02(spark, sf):
    return Q.unique_failures(staged_faulty(spark, sf), "id")


@query("q03_accepted_values")
def q03(spark, sf):
    # 'neutral' is left out of the list on purpose, so the check has failures to report.
    return Q.accepted_values_failures(fct_l(spark, sf), "rsi_signal", ["oversold", "overbought"]) \
        .select("symbol", "date", "rsi_signal")


@query("q04_negative_volume")
def q04(spark, sf):
    # Daily sums of view E never go negative, so the singular test runs on the
    # unfiltered rows (with their date) where the planted negative volumes are.
    raw = raw_e(spark, sf).withColumn("date", F.to_date(F.timestamp_millis("timestamp_ms")))
    return rounded(Q.negative_volume(raw))


@query("q05_check_report")
def q05(spark, sf):
    """The checks of a run: row checks counted as the tables are written, ``unique`` asked of the staged ids."""
    from barline.session import stored
    raw = V.with_key_faults(raw_e(spark, sf))
    staged = S.stg_raw_ohlcv(raw)
    seen = [Q.observed(Q.TableChecks("stg_raw_ohlcv", staged, not_null=("id", "symbol", "timestamp_ms", "volume")))]
    seen.append(Q.observed(Q.TableChecks("int_ohlcv_daily", C.int_ohlcv_daily(seen[0].df, E_ORDER), not_null=("symbol", "date", "volume"))))
    inter = stored(seen[1].df, "int_ohlcv_daily")
    ind = IND.compute_all_indicators(stored(C.daily_candles(raw, E_ORDER), "ohlcv_daily"), partition_by=("symbol", "exchange"))
    seen.append(Q.observed(Q.TableChecks(
        "fct_market_daily", M.fct_market_daily(inter, ind, ("symbol", "exchange", "date")), not_null=("symbol", "date", "close"),
        accepted={"rsi_signal": RSI_SIGNALS, "bb_position": BAND_POSITIONS}, custom={"assert_positive_volume": F.col("volume") < 0})))
    stored(seen[2].df, "fct_market_daily")
    return Q.observed_report(spark, seen, [Q.TableChecks("stg_raw_ohlcv", staged, unique=("id",))])


def parsed_messages(spark, sf):
    return MSG.parse_messages(V.messages(spark, sf).filter(F.col("value").isNotNull()))


@query("q06_freshness")
def q06(spark, sf):
    return Q.freshness(staged_e(spark, sf), MSG.dead_letters(parsed_messages(spark, sf)), now_col(),
                       max_age="1 hour", reject_window="5 minutes")


@query("q06_failed_runs")
def q06r(spark, sf):
    return Q.failed_runs(RL.current_runs(run_events(spark, sf)), now_col(), "20 days")


# ---------------------------------------------------------------- monitoring
def run_events(spark, sf):
    runs = V.runs_from_raw(raw_e(spark, sf))
    ends = RL.end_events(runs.filter(F.col("status").isNotNull()), V.DAG_ID)
    return RL.start_events(runs, V.DAG_ID).unionByName(ends)


def stored_tables_e(spark, sf):
    """The run's tables over view E, each written once, and the run log's current states."""
    from barline.session import stored
    raw = stored(raw_e(spark, sf), "raw_ohlcv")
    state = stored(C.candle_state(raw, "hour", E_ORDER), "candle_state")
    daily = stored(C.candles_of(C.merge_states(state)), "ohlcv_daily")
    return {"raw_ohlcv": raw, "ohlcv_hourly": stored(C.candles_of(state), "ohlcv_hourly"), "ohlcv_daily": daily,
            "technical_indicators": stored(IND.compute_all_indicators(daily, partition_by=("symbol", "exchange")), "technical_indicators"),
            "pipeline_runs": stored(RL.current_runs(run_events(spark, sf)), "pipeline_runs")}


@query("a08_table_counts")
def a08(spark, sf):
    return MON.table_counts(stored_tables_e(spark, sf))


@query("a08_health")
def a08h(spark, sf):
    tables = stored_tables_e(spark, sf)
    runs = tables.pop("pipeline_runs")
    return MON.health(spark, tables, runs, now_col(), "20 days")


@query("a09_high_water_mark")
def a09(spark, sf):
    raw = raw_e(spark, sf)
    from barline.operators.dedupe import high_water_mark, high_water_marks
    return high_water_marks(raw).unionByName(high_water_mark(raw, "UNKNOWN/PAIR"))


@query("a10_ingest_rate")
def a10(spark, sf):
    return MON.ingest_rate(raw_e(spark, sf), now_col(), 24)


@query("a11_message_throughput")
def a11(spark, sf):
    return rounded(MON.message_throughput(V.messages(spark, sf), 5))


@query("a11_dead_letter_counts")
def a11b(spark, sf):
    return MON.dead_letter_counts(MSG.dead_letters(parsed_messages(spark, sf)))


@query("k01_latest_closes")
def k01(spark, sf):
    return rounded(MON.latest_closes(daily_l(spark, sf), LONG_SYMBOL))


@query("k02_latest_moving_averages")
def k02(spark, sf):
    return rounded(MON.latest_moving_averages(stored_indicators_l(spark, sf), LONG_SYMBOL))


@query("k03_latest_rsi")
def k03(spark, sf):
    return rounded(MON.latest_rsi(stored_indicators_l(spark, sf), LONG_SYMBOL))


@query("k04_latest_runs")
def k04(spark, sf):
    return rounded(MON.latest_runs(RL.current_runs(run_events(spark, sf))))


@query("p09_run_status_code")
def p09(spark, sf):
    runs = RL.current_runs(run_events(spark, sf))
    return rounded(runs.select("run_id", "status", run_status_code().alias("status_code")))


@query("p10_predicates")
def p10(spark, sf):
    rows = MON.within_hours(staged_e(spark, sf), "candle_time", now_col(), 24)
    return rounded(MON.symbol_rows(rows, "click").select("id", "symbol", "candle_time", "close"))


@query("r01_run_start")
def r01(spark, sf):
    return RL.start_events(V.runs_from_raw(raw_e(spark, sf)), V.DAG_ID)


@query("r02_run_state")
def r02(spark, sf):
    return RL.current_runs(run_events(spark, sf))


@query("r03_daily_run")
def r03(spark, sf):
    from barline.plans.daily_run import daily_run
    from barline.session import work_path
    fixed = datetime.datetime(2024, 2, 1)
    return daily_run(spark, raw_l(spark, sf), work_path(spark, "r03"), "r03", order_by=L_ORDER,
                     series=("symbol",), extra=("line", "part"), order_bits=L_BITS,
                     clock=lambda: fixed)


# ---------------------------------------------------------------- sources

RAW_OUT = ("id", "symbol", "exchange", "timestamp_ms", "open", "high", "low", "close", "volume")
TARGET_BEFORE_L = "1998-01-01"      # yesterday's table vs today's batch (S07, J03)
BATCH_FROM_L = "1997-01-01"



@query("s01_read_table")
def s01(spark, sf):
    li = read_table(spark, f"{sf.rstrip('/')}/lineitem.parquet",
                    columns=["l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                             "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"])
    return rounded(V.candles_from_lineitem(li).select(*RAW_OUT, "line", "part"))


@query("s02_write_table")
def s02(spark, sf):
    from barline.session import work_path
    path = work_path(spark, "s02")
    raw = raw_e(spark, sf).withColumn("candle_date", F.to_date(F.timestamp_millis("timestamp_ms")))
    for _ in range(2):   # a re-run replaces its partitions instead of appending twice
        write_table(raw, path, mode="overwrite", partition_by=["candle_date"])
    return rounded(read_table(spark, path).select(*RAW_OUT, "candle_date"))


@query("s05_decode_messages")
def s05(spark, sf):
    v = MSG.valid_records(parsed_messages(spark, sf))
    return rounded(v.select("offset", "symbol", "exchange", "timeframe", "timestamp_ms", "open",
                            "high", "low", "close", "volume"))


@query("s06_dead_letters")
def s06(spark, sf):
    return MSG.dead_letters(parsed_messages(spark, sf)).select(
        "offset", "partition", "error_reason", "reason_detail", F.hex("value").alias("value_hex"),
        F.col("headers")[0]["key"].alias("header_key"), F.decode(F.col("headers")[0]["value"], "UTF-8").alias("header_value"))


@query("s07_insert_ignore")
def s07(spark, sf):
    raw = raw_l(spark, sf)
    day = F.to_date(F.timestamp_millis("timestamp_ms"))
    target = D.new_rows(raw.filter(day < F.lit(TARGET_BEFORE_L).cast("date")), None, order_by=L_ORDER)
    batch = raw.filter(day >= F.lit(BATCH_FROM_L).cast("date"))
    return rounded(D.new_rows(batch, target, order_by=L_ORDER).select(*RAW_OUT, "line", "part"))


@query("j03_anti_join")
def j03(spark, sf):
    raw = raw_l(spark, sf)
    day = F.to_date(F.timestamp_millis("timestamp_ms"))
    target = raw.filter(day < F.lit(TARGET_BEFORE_L).cast("date"))
    return rounded(D.anti_join(raw, target).select(*RAW_OUT, "line", "part"))


@query("s08_encode_messages")
def s08(spark, sf):
    recs = MSG.normalise_records(raw_e(spark, sf))   # the optional fields come from S09
    enc = MSG.encode_messages(recs)
    back = F.from_json(F.decode("value", "UTF-8"), MSG.CANDLE_MESSAGE)
    return rounded(enc.select(F.decode("key", "UTF-8").alias("key"), back.alias("r"))
                   .select("key", "r.symbol", "r.exchange", "r.timeframe", "r.timestamp_ms",
                           "r.open", "r.high", "r.low", "r.close", "r.volume", "r.fetched_at"))


@query("s09_normalise_records")
def s09(spark, sf):
    raw = V.candles_from_events(V.read_test_table(spark, sf, "events"), keep=("user_id",))
    strings = raw.select(
        "id", *[F.col(c).cast("string").alias(c) for c in ("symbol", "exchange", "timestamp_ms",
                                                          "open", "high", "low", "close", "volume")],
        F.when(F.col("user_id") % 3 == 0, F.lit(None)).otherwise(F.lit("5m")).alias("timeframe"),
        F.when(F.col("user_id") % 5 == 0, F.lit(None))
        .otherwise(F.date_format("ingested_at", "yyyy-MM-dd'T'HH:mm:ss")).alias("fetched_at"))
    return rounded(MSG.normalise_records(strings))


@query("s10_newer_than_last")
def s10(spark, sf):
    raw = raw_e(spark, sf)
    from barline.session import work_path
    path = work_path(spark, "marks")
    for until in ("2024-01-10", TARGET_BEFORE_E):     # two earlier batches leave their marks
        D.update_marks(spark, path, raw.filter(F.col("ingested_at") < F.to_timestamp(F.lit(until))))
    return D.newer_than_marks(raw, D.read_marks(spark, path)).select("id", "symbol", "timestamp_ms")


@query("s11_historical_load")
def s11(spark, sf):
    from barline.session import work_path
    path = work_path(spark, "s11")
    e = raw_e(spark, sf).select(*RAW_OUT, "ingested_at", F.lit(0).cast("long").alias("line"),
                                F.lit(0).cast("long").alias("part"))
    write_table(e, path, mode="overwrite")
    staging = read_table(spark, path)
    files = raw_l(spark, sf).select(*RAW_OUT, "ingested_at", "line", "part")
    batch = files.unionByName(e)                      # the bulk files plus a replay of staging
    fresh = D.new_rows(batch, staging, order_by=L_ORDER)
    write_table(fresh, path, mode="append")
    return rounded(read_table(spark, path).select(*RAW_OUT))


@query("s12_array_to_record")
def s12(spark, sf):
    raw = raw_e(spark, sf)
    arr = raw.select("symbol", "exchange", F.array(
        F.col("timestamp_ms").cast("double"), "open", "high", "low", "close", "volume").alias("candle"))
    recs = MSG.records_from_arrays(arr, "symbol", "exchange", "1m",
                                   fetched_at=F.lit("2024-02-01T00:00:00+00:00"))
    return rounded(recs)


# ---------------------------------------------------------------- streaming

MESSAGE_FILES = 4
#: A scan gives a whole row group to one task. The default (128 MB) is 1.5 million messages,
#: so that one task decoded a batch of one file; 2 MB is some 25,000, a second's work.
MESSAGE_ROW_GROUP = 2 << 20


def message_files(spark, sf) -> str:
    """Write the message view as a few Parquet files, of row groups that a batch's tasks share: the stream's source."""
    from barline.session import work_path
    path = work_path(spark, "messages")
    (V.messages(spark, sf).repartition(MESSAGE_FILES, "partition", "offset").write
     .option("parquet.block.size", MESSAGE_ROW_GROUP).parquet(path))
    return path


def _ingest_paths(spark, name):
    from barline.session import work_path
    base = work_path(spark, name)
    return f"{base}/checkpoint", f"{base}/staging", f"{base}/dead_letters", base


STAGED_OUT = (*RAW_OUT, "ingested_at")


@query("s03_message_source")
def s03(spark, sf):
    from barline.session import work_path
    src = message_files(spark, sf)
    out, ck = work_path(spark, "s03-out"), work_path(spark, "s03-ck")
    stream = ING.drop_tombstones(spark.readStream.schema(ING.MESSAGE_ENVELOPE).parquet(src))
    q = (stream.select("topic", "partition", "offset").writeStream.format("parquet")
         .option("checkpointLocation", ck).trigger(availableNow=True).start(out))
    q.awaitTermination()
    return spark.read.parquet(out)


@query("s04_micro_batch_ingest")
def s04(spark, sf):
    src = message_files(spark, sf)
    ck, staging, dlq, _ = _ingest_paths(spark, "s04")
    ING.drain(spark, src, ck, staging, dlq, source_options={"maxFilesPerTrigger": "1"},
              ingested_at="timestamp")
    return rounded(ING.read_staging(spark, staging).select(*STAGED_OUT))


@query("s04_compacted_staging")
def s04c(spark, sf):
    """The staging table after every second batch packed its small files."""
    src = message_files(spark, sf)
    ck, staging, dlq, _ = _ingest_paths(spark, "s04c")
    ING.drain(spark, src, ck, staging, dlq, source_options={"maxFilesPerTrigger": "1"}, ingested_at="timestamp", compact_every=2)
    return rounded(ING.read_staging(spark, staging).select(*STAGED_OUT))


@query("r03_incremental_run")
def r03i(spark, sf):
    """The run on the ingest's own table, after each of two batches; the second batch's rows are late for every date."""
    from barline.plans.incremental_run import incremental_run
    src = message_files(spark, sf)
    ck, staging, dlq, base = _ingest_paths(spark, "r03i")
    fixed = datetime.datetime(2024, 2, 1)

    def run(batch_id, _opened):
        incremental_run(spark, ING.staging_table(spark, staging), f"{base}/out", f"r{batch_id}", series=("symbol", "exchange"), clock=lambda: fixed)

    ING.drain(spark, src, ck, staging, dlq, source_options={"maxFilesPerTrigger": str(MESSAGE_FILES // 2)}, ingested_at="timestamp", after_batch=run)
    fct = spark.read.parquet(f"{base}/out/fct_market_daily")
    return rounded(fct.select("symbol", "exchange", "date", "open", "close", "volume", "candle_count", "sma_25", "ema_26", "macd_signal", "obv", "rsi_signal"))


@query("t01_stream_dead_letters")
def t01(spark, sf):
    src = message_files(spark, sf)
    ck, staging, dlq, _ = _ingest_paths(spark, "t01")
    ING.drain(spark, src, ck, staging, dlq, source_options={"maxFilesPerTrigger": "1"},
              ingested_at="timestamp")
    return ING.read_dead_letters(spark, dlq).select("offset", "partition", "error_reason", "reason_detail", F.hex("value").alias("value_hex"))


@query("t02_bounded_drain_replay")
def t02(spark, sf):
    src = message_files(spark, sf)
    ck, staging, dlq, base = _ingest_paths(spark, "t02")
    ING.drain(spark, src, ck, staging, dlq, ingested_at="timestamp")
    # A full redelivery (new checkpoint = offsets lost) must not change either table.
    ING.drain(spark, src, f"{base}/checkpoint2", staging, dlq,
              source_options={"maxFilesPerTrigger": "2"}, ingested_at="timestamp")
    return rounded(ING.read_staging(spark, staging).select(*STAGED_OUT))


@query("t03_failed_flush_restart")
def t03(spark, sf):
    src = message_files(spark, sf)
    ck, staging, dlq, _ = _ingest_paths(spark, "t03")

    def fail_in_second(batch_id: int) -> None:
        if batch_id == 1:
            raise RuntimeError("injected failure")
    opts = {"maxFilesPerTrigger": "1"}
    try:
        ING.drain(spark, src, ck, staging, dlq, source_options=opts, ingested_at="timestamp",
                  before_batch=fail_in_second)
    except StreamingQueryException as exc:
        if "injected failure" not in str(exc):
            raise
    else:
        raise RuntimeError("the injected failure did not stop the query")
    ING.drain(spark, src, ck, staging, dlq, source_options=opts, ingested_at="timestamp")
    return rounded(ING.read_staging(spark, staging).select(*STAGED_OUT))
