"""DuckDB oracle SQL for every named query (same names as ``queries()``).

The candle views are written here a second time, in SQL, from the same fixed
rules as ``barline.sources.candle_views``; every query then states its
operator's semantics directly in SQL (ordered aggregates, window frames,
recursive CTEs) without reusing the Spark code.
"""

from __future__ import annotations

RAW_E = """raw_e AS (
  SELECT event_id AS id, event_type AS symbol,
         CASE WHEN user_id % 2 = 0 THEN 'ex_a' ELSE 'ex_b' END AS exchange,
         epoch_us(ts) // 1000 AS timestamp_ms,
         CASE WHEN event_id % 103 = 0 THEN 0.0::DOUBLE ELSE value END AS open,
         CASE WHEN event_id % 97 = 0 THEN least(value, bc) - 0.5 ELSE greatest(value, bc) + 0.5 END AS high,
         CASE WHEN event_id % 97 = 0 THEN greatest(value, bc) + 0.5 ELSE least(value, bc) - 0.5 END AS low,
         bc AS close,
         CASE WHEN event_id % 101 = 0 THEN -bv ELSE bv END AS volume,
         ts AS ingested_at
  FROM (SELECT *, value + CAST(event_id % 11 - 5 AS DOUBLE) * 0.25 AS bc,
               CAST(1 + user_id % 50 AS DOUBLE) AS bv FROM events) ev)"""

RAW_L = """raw_l AS (
  SELECT l_orderkey AS id, l_returnflag || '/' || l_linestatus AS symbol, 'x' AS exchange,
         epoch_us(l_shipdate) // 1000 AS timestamp_ms,
         l_extendedprice / l_quantity AS open,
         l_extendedprice / l_quantity + 0.5 AS high,
         l_extendedprice / l_quantity - 0.5 AS low,
         l_extendedprice / l_quantity AS close,
         l_quantity AS volume, l_shipdate AS ingested_at,
         CAST(l_linenumber AS BIGINT) AS line, l_partkey AS part
  FROM lineitem)"""

ORACLE: dict[str, str] = {}
GRID = "CAST(1048576 AS DOUBLE)"


def with_views(body: str) -> str:
    return f"WITH {RAW_E},\n{RAW_L},\n{body}"


def rnd(sql: str, doubles: list[str] | tuple[str, ...]) -> str:
    if not doubles:
        return sql
    # Snap to a binary grid of 2^-20 (about 1e-6): decimal ties (x.xxxxxx5,
    # common when dividing by powers of two) cannot flip the comparison.
    rep = ", ".join(f"round({c} * {GRID}) / {GRID} + CAST(0 AS DOUBLE) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS q"


def candle_sql(src: str, bucket: str, order: str) -> str:
    b = ("date_trunc('hour', epoch_ms(timestamp_ms)) AS hour_start" if bucket == "hour"
         else "CAST(epoch_ms(timestamp_ms) AS DATE) AS date")
    bname = "hour_start" if bucket == "hour" else "date"
    return f"""SELECT symbol, exchange, {b},
       first(open ORDER BY {order}) AS open, max(high) AS high, min(low) AS low,
       last(close ORDER BY {order}) AS close, sum(volume) AS volume,
       count(*) AS trade_count,
       CASE WHEN sum(volume) > 0 THEN sum(close * volume) / sum(volume) END AS vwap
FROM {src} GROUP BY symbol, exchange, {bname}"""


CANDLE_DOUBLES = ["open", "high", "low", "close", "volume", "vwap"]
E_ORD = "timestamp_ms, id"
L_ORD = "timestamp_ms, id, line, part"

ORACLE["a01_hourly_candles"] = with_views(
    "c AS (" + candle_sql("raw_e", "hour", E_ORD) + ")\n" + rnd("SELECT * FROM c", CANDLE_DOUBLES))
ORACLE["a02_daily_candles"] = with_views(
    "c AS (" + candle_sql("raw_e", "day", E_ORD) + ")\n" + rnd("SELECT * FROM c", CANDLE_DOUBLES))
ORACLE["a02_daily_candles_long"] = with_views(
    "c AS (" + candle_sql("raw_l", "day", L_ORD) + ")\n" + rnd("SELECT * FROM c", CANDLE_DOUBLES))


def with_views_rec(body: str) -> str:
    return f"WITH RECURSIVE {RAW_E},\n{RAW_L},\n{body}"


def dbl(x: float) -> str:
    """A double literal that parses to exactly ``x``."""
    return f"CAST('{x!r}' AS DOUBLE)"


def stg_sql(src: str, extra: str = "") -> str:
    """P01-P04 over a raw view."""
    ct = "make_timestamp((timestamp_ms // 1000) * 1000000)"
    return f"""SELECT * FROM (
  SELECT id, symbol, exchange, timestamp_ms, {ct} AS candle_time,
         date_trunc('hour', {ct}) AS hour_bucket, CAST({ct} AS DATE) AS date_bucket,
         open, high, low, close, volume, ingested_at,
         CASE WHEN high < low THEN true ELSE false END AS is_invalid_hl,
         CASE WHEN volume < 0 THEN true ELSE false END AS is_negative_volume,
         CASE WHEN open <= 0 OR close <= 0 THEN true ELSE false END AS is_zero_price{extra}
  FROM {src}) s
WHERE NOT is_invalid_hl AND NOT is_negative_volume AND NOT is_zero_price"""


def int_daily_sql(src: str, order: str) -> str:
    """A05 over a staged view."""
    fo = f"first(open ORDER BY {order})"
    lc = f"last(close ORDER BY {order})"
    return f"""SELECT symbol, exchange, date_bucket AS date, {fo} AS open, max(high) AS high,
       min(low) AS low, {lc} AS close, sum(volume) AS volume, count(*) AS candle_count,
       CASE WHEN sum(volume) > 0 THEN sum(close * volume) / sum(volume) END AS vwap,
       CASE WHEN {fo} > 0 THEN {lc} / {fo} - 1 END AS daily_return
FROM {src} GROUP BY symbol, exchange, date_bucket"""


def ema_consts(span: int) -> tuple[str, str]:
    a = 2.0 / (span + 1.0)
    return dbl(a), dbl(1.0 - a)


def indicators_sql(src: str, part: str = "symbol") -> str:
    """W01, W05-W11 over a daily view; defines CTEs ib, i1, ema, ind."""
    pcols = [p.strip() for p in part.split(",")]
    on = " AND ".join(f"b.{p} IS NOT DISTINCT FROM e.{p}" for p in pcols)
    on_i = " AND ".join(f"i1.{p} IS NOT DISTINCT FROM ema.{p}" for p in pcols)
    sel = ", ".join(f"b.{p}" for p in pcols)
    a12, r12 = ema_consts(12)
    a26, r26 = ema_consts(26)

    def rows(n):
        return f"(PARTITION BY {part} ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"""ib AS (
  SELECT {part}, date, high, low, close, volume,
         lag(close) OVER (PARTITION BY {part} ORDER BY date) AS prev,
         close - lag(close) OVER (PARTITION BY {part} ORDER BY date) AS chg,
         row_number() OVER (PARTITION BY {part} ORDER BY date) AS rn
  FROM {src}),
i1 AS (
  SELECT {part}, date, close, rn,
         avg(close) OVER {rows(7)} AS sma_7,
         avg(close) OVER {rows(25)} AS sma_25,
         avg(close) OVER {rows(99)} AS sma_99,
         avg(CASE WHEN chg > 0 THEN chg ELSE 0.0 END) OVER {rows(14)} AS ag,
         avg(CASE WHEN chg < 0 THEN abs(chg) ELSE 0.0 END) OVER {rows(14)} AS al,
         avg(close) OVER {rows(20)} AS bb_middle,
         stddev_samp(close) OVER {rows(20)} AS sd20,
         avg(greatest(high - low, abs(high - prev), abs(low - prev))) OVER {rows(14)} AS atr_14,
         sum(CASE WHEN close > prev THEN volume WHEN close < prev THEN -volume ELSE 0.0 END)
           OVER (PARTITION BY {part} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS obv
  FROM ib),
ema AS (
  SELECT {part}, rn, close AS ema_12, close AS ema_26 FROM ib WHERE rn = 1
  UNION ALL
  SELECT {sel}, b.rn, {a12} * b.close + {r12} * e.ema_12, {a26} * b.close + {r26} * e.ema_26
  FROM ema e JOIN ib b ON {on} AND b.rn = e.rn + 1),
i2 AS (
  SELECT i1.*, ema.ema_12, ema.ema_26, ema.ema_12 - ema.ema_26 AS macd
  FROM i1 JOIN ema ON {on_i} AND i1.rn = ema.rn),
ind AS (
  SELECT {part}, date, sma_7, sma_25, sma_99, ema_12, ema_26,
         CASE WHEN al = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1.0 + ag / al) END AS rsi_14,
         macd, avg(macd) OVER {rows(9)} AS macd_signal,
         macd - avg(macd) OVER {rows(9)} AS macd_histogram,
         bb_middle + 2.0 * sd20 AS bb_upper, bb_middle, bb_middle - 2.0 * sd20 AS bb_lower,
         atr_14, obv
  FROM i2)"""


IND_COLS = ["sma_7", "sma_25", "sma_99", "ema_12", "ema_26", "rsi_14", "macd", "macd_signal",
            "macd_histogram", "bb_upper", "bb_middle", "bb_lower", "atr_14", "obv"]
DL = "dl AS (" + candle_sql("raw_l", "day", L_ORD) + ")"
DE = "de AS (" + candle_sql("raw_e", "day", E_ORD) + ")"
STG_E = "stg_e AS (" + stg_sql("raw_e") + ")"
STG_L = "stg_l AS (" + stg_sql("raw_l", ", line, part") + ")"
INT_E = "int_e AS (" + int_daily_sql("stg_e", E_ORD) + ")"
INT_L = "int_l AS (" + int_daily_sql("stg_l", L_ORD) + ")"


def q(body_ctes: list[str], select: str, doubles=(), recursive=False) -> str:
    w = with_views_rec if recursive else with_views
    return w(",\n".join(body_ctes) + "\n" + rnd(select, list(doubles)))


ORACLE["a03_vwap"] = q(["c AS (" + candle_sql("raw_e", "hour", E_ORD) + ")"],
                       "SELECT symbol, exchange, hour_start, volume, vwap FROM c", ["volume", "vwap"])
ORACLE["a04_first_last_value"] = q([], f"""SELECT symbol, date_trunc('month', epoch_ms(timestamp_ms)) AS month,
  first(open ORDER BY {L_ORD}) AS first_open, last(close ORDER BY {L_ORD}) AS last_close
FROM raw_l GROUP BY 1, 2""", ["first_open", "last_close"])
ORACLE["a05_int_ohlcv_daily"] = q([STG_E, INT_E], "SELECT * FROM int_e",
                                  ["open", "high", "low", "close", "volume", "vwap", "daily_return"])
ORACLE["j01_candles_rank_join"] = ORACLE["a01_hourly_candles"]
ORACLE["w12_first_last_rows"] = q(["r AS (SELECT *, CAST(epoch_ms(timestamp_ms) AS DATE) AS date, "
                                   "row_number() OVER (PARTITION BY symbol, exchange, CAST(epoch_ms(timestamp_ms) AS DATE) ORDER BY timestamp_ms, id) AS rf, "
                                   "row_number() OVER (PARTITION BY symbol, exchange, CAST(epoch_ms(timestamp_ms) AS DATE) ORDER BY timestamp_ms DESC, id DESC) AS rl FROM raw_e)"],
                                  "SELECT 'first' AS which, symbol, exchange, date, id, open, close FROM r WHERE rf = 1 "
                                  "UNION ALL SELECT 'last', symbol, exchange, date, id, open, close FROM r WHERE rl = 1",
                                  ["open", "close"])
CT = "make_timestamp((timestamp_ms // 1000) * 1000000)"
ORACLE["p01_time_columns"] = q([], f"""SELECT id, timestamp_ms, {CT} AS candle_time,
  date_trunc('hour', {CT}) AS hour_bucket, CAST({CT} AS DATE) AS date_bucket FROM raw_e""")
ORACLE["p02_quality_flags"] = q([], """SELECT id,
  CASE WHEN high < low THEN true ELSE false END AS is_invalid_hl,
  CASE WHEN volume < 0 THEN true ELSE false END AS is_negative_volume,
  CASE WHEN open <= 0 OR close <= 0 THEN true ELSE false END AS is_zero_price FROM raw_e""")
ORACLE["p03_quality_filter"] = q([STG_E], "SELECT id, symbol, exchange, timestamp_ms, open, high, low, close, volume FROM stg_e",
                                 ["open", "high", "low", "close", "volume"])
ORACLE["p04_stg_raw_ohlcv"] = q([STG_E], "SELECT * FROM stg_e", ["open", "high", "low", "close", "volume"])
ORACLE["p05_select_rename"] = q([], "SELECT id, symbol, open AS open_price, close AS close_price FROM raw_e",
                                ["open_price", "close_price"])

ORACLE["w01_sma"] = q([DL], """SELECT symbol, date,
  avg(close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS sma_7,
  avg(close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 24 PRECEDING AND CURRENT ROW) AS sma_25,
  avg(close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 98 PRECEDING AND CURRENT ROW) AS sma_99
FROM dl""", ["sma_7", "sma_25", "sma_99"])
ORACLE["w02_sma_macro"] = q([DE], """SELECT symbol, exchange, date,
  avg(close) OVER (PARTITION BY symbol, exchange ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS sma_5
FROM de""", ["sma_5"])
ORACLE["w03_pct_change"] = q([DL], """SELECT symbol, date,
  (close - lag(close, 1) OVER w) / nullif(lag(close, 1) OVER w, 0) AS pct_1,
  (close - lag(close, 7) OVER w) / nullif(lag(close, 7) OVER w, 0) AS pct_7
FROM dl WINDOW w AS (PARTITION BY symbol ORDER BY date)""", ["pct_1", "pct_7"])
ORACLE["w04_rolling_std"] = q([DL], """SELECT symbol, date,
  stddev_samp(close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS std_20
FROM dl""", ["std_20"])
ORACLE["w05_ema"] = q([DL, indicators_sql("dl")], "SELECT d.symbol, d.date, d.close, ind.ema_12, ind.ema_26 "
                      "FROM dl d JOIN ind USING (symbol, date)", ["close", "ema_12", "ema_26"], True)
ORACLE["w06_rsi"] = q([DL, indicators_sql("dl")], "SELECT symbol, date, rsi_14 FROM ind", ["rsi_14"], True)
ORACLE["w07_macd"] = q([DL, indicators_sql("dl")], "SELECT symbol, date, macd, macd_signal, macd_histogram FROM ind",
                       ["macd", "macd_signal", "macd_histogram"], True)
ORACLE["w08_bollinger"] = q([DL, indicators_sql("dl")], "SELECT symbol, date, bb_upper, bb_middle, bb_lower FROM ind",
                            ["bb_upper", "bb_middle", "bb_lower"], True)
ORACLE["w09_atr"] = q([DL, indicators_sql("dl")], "SELECT symbol, date, atr_14 FROM ind", ["atr_14"], True)
ORACLE["w10_obv"] = q([DL, indicators_sql("dl")], "SELECT symbol, date, obv FROM ind", ["obv"], True)
ORACLE["w11_all_indicators"] = q([DL, indicators_sql("dl")], "SELECT * FROM ind", IND_COLS, True)
ORACLE["w13_lag"] = q([DL], """SELECT symbol, date, close,
  lag(close, 1) OVER (PARTITION BY symbol ORDER BY date) AS close_lag_1,
  lag(close, 5) OVER (PARTITION BY symbol ORDER BY date) AS close_lag_5 FROM dl""",
                      ["close", "close_lag_1", "close_lag_5"])

FCT_SELECT = """SELECT d.symbol, d.exchange, d.date, d.open, d.high, d.low, d.close, d.volume,
  d.candle_count, d.vwap, d.daily_return, i.sma_7, i.sma_25, i.sma_99, i.ema_12, i.ema_26,
  i.rsi_14, i.macd, i.macd_signal, i.macd_histogram, i.bb_upper, i.bb_middle, i.bb_lower,
  i.atr_14, i.obv,
  CASE WHEN i.rsi_14 < 30 THEN 'oversold' WHEN i.rsi_14 > 70 THEN 'overbought' ELSE 'neutral' END AS rsi_signal,
  CASE WHEN i.macd > i.macd_signal THEN 'bullish' WHEN i.macd < i.macd_signal THEN 'bearish' ELSE 'neutral' END AS macd_signal_direction,
  CASE WHEN d.close > i.bb_upper THEN 'above_upper' WHEN d.close < i.bb_lower THEN 'below_lower' ELSE 'within_bands' END AS bb_position
FROM {daily} d LEFT JOIN ind i ON {on}"""
FCT_DOUBLES = ["open", "high", "low", "close", "volume", "vwap", "daily_return", *IND_COLS]
FCT_L = "fct AS (" + FCT_SELECT.format(daily="int_l", on="d.symbol = i.symbol AND d.date = i.date") + ")"
ORACLE["m01_fct_market_daily"] = q([DL, STG_L, INT_L, indicators_sql("dl"), FCT_L], "SELECT * FROM fct",
                                   FCT_DOUBLES, True)
ORACLE["m01_fct_market_daily_by_exchange"] = q(
    [DE, STG_E, INT_E, indicators_sql("de", "symbol, exchange"),
     "fct AS (" + FCT_SELECT.format(daily="int_e", on="d.symbol = i.symbol AND d.exchange = i.exchange AND d.date = i.date") + ")"],
    "SELECT * FROM fct", FCT_DOUBLES, True)
ORACLE["j02_daily_left_join_indicators"] = q(
    [DL, STG_L, INT_L, indicators_sql("dl")],
    "SELECT d.symbol, d.date, d.close, i.sma_7, i.ema_12, i.rsi_14, i.obv FROM int_l d LEFT JOIN ind i "
    "ON d.symbol = i.symbol AND d.date = i.date", ["close", "sma_7", "ema_12", "rsi_14", "obv"], True)
ORACLE["p06_rsi_signal"] = q([DL, STG_L, INT_L, indicators_sql("dl"), FCT_L],
                             "SELECT symbol, date, rsi_14, rsi_signal FROM fct", ["rsi_14"], True)
ORACLE["p07_macd_direction"] = q([DL, STG_L, INT_L, indicators_sql("dl"), FCT_L],
                                 "SELECT symbol, date, macd_signal_direction FROM fct", [], True)
ORACLE["p08_band_position"] = q([DL, STG_L, INT_L, indicators_sql("dl"), FCT_L],
                                "SELECT symbol, date, bb_position FROM fct", [], True)

PAIR_STATS = """SELECT symbol, exchange, min(date) AS first_date, max(date) AS last_date,
  count(*) AS total_days, avg(volume) AS avg_daily_volume, avg(daily_return) AS avg_daily_return,
  stddev_samp(daily_return) AS volatility, min(low) AS all_time_low, max(high) AS all_time_high
FROM {src} GROUP BY symbol, exchange"""
DIM = """SELECT *, volatility * sqrt(365.0) AS annualized_volatility,
  CASE WHEN volatility > 0 THEN (avg_daily_return * 365.0) / (volatility * sqrt(365.0)) END AS sharpe_ratio
FROM ps"""
PS_DOUBLES = ["avg_daily_volume", "avg_daily_return", "volatility", "all_time_low", "all_time_high"]
ORACLE["a06_pair_stats"] = q([STG_E, INT_E, "ps AS (" + PAIR_STATS.format(src="int_e") + ")"],
                             "SELECT * FROM ps", PS_DOUBLES)
ORACLE["a07_risk_ratios"] = q([STG_E, INT_E, "ps AS (" + PAIR_STATS.format(src="int_e") + ")", "dim AS (" + DIM + ")"],
                              "SELECT symbol, exchange, annualized_volatility, sharpe_ratio FROM dim",
                              ["annualized_volatility", "sharpe_ratio"])
ORACLE["m02_dim_trading_pairs"] = q([STG_E, INT_E, "ps AS (" + PAIR_STATS.format(src="int_e") + ")", "dim AS (" + DIM + ")"],
                                    "SELECT * FROM dim", PS_DOUBLES + ["annualized_volatility", "sharpe_ratio"])
ORACLE["m02_dim_trading_pairs_long"] = q([STG_L, INT_L, "ps AS (" + PAIR_STATS.format(src="int_l") + ")", "dim AS (" + DIM + ")"],
                                         "SELECT * FROM dim", PS_DOUBLES + ["annualized_volatility", "sharpe_ratio"])


# ---------------------------------------------------------------- quality
RAW_EF = """raw_ef AS (
  SELECT CASE WHEN id % 199 = 0 THEN id - 1 ELSE id END AS id,
         CASE WHEN id % 211 = 0 THEN NULL ELSE symbol END AS symbol,
         exchange, timestamp_ms, open, high, low, close, volume, ingested_at FROM raw_e)"""
STG_EF = "stg_ef AS (" + stg_sql("raw_ef") + ")"
ORACLE["q01_not_null"] = q([RAW_EF, STG_EF], "SELECT id, timestamp_ms FROM stg_ef WHERE symbol IS NULL")
ORACLE["q02_unique"] = q([RAW_EF, STG_EF], "SELECT id, count(*) AS n_records FROM stg_ef WHERE id IS NOT NULL "
                                           "GROUP BY id HAVING count(*) > 1")
ORACLE["q03_accepted_values"] = q([DL, STG_L, INT_L, indicators_sql("dl"), FCT_L],
                                  "SELECT symbol, date, rsi_signal FROM fct WHERE rsi_signal IS NOT NULL "
                                  "AND rsi_signal NOT IN ('oversold', 'overbought')", [], True)
ORACLE["q04_negative_volume"] = q([], "SELECT CAST(epoch_ms(timestamp_ms) AS DATE) AS date, symbol, volume "
                                     "FROM raw_e WHERE volume < 0", ["volume"])

DEF = "def AS (" + candle_sql("raw_ef", "day", E_ORD) + ")"
INT_EF = "int_ef AS (" + int_daily_sql("stg_ef", E_ORD) + ")"
FCT_EF = "fct AS (" + FCT_SELECT.format(
    daily="int_ef", on="d.symbol = i.symbol AND d.exchange = i.exchange AND d.date = i.date") + ")"


def nn(table: str, src: str, col: str) -> str:
    return (f"SELECT 'not_null' AS check_name, '{table}' AS table_name, '{col}' AS column_name, "
            f"count(*) FILTER (WHERE {col} IS NULL) AS failures FROM {src}")


REPORT = " UNION ALL ".join(
    [nn("stg_raw_ohlcv", "stg_ef", c) for c in ("id", "symbol", "timestamp_ms", "volume")]
    + ["SELECT 'unique', 'stg_raw_ohlcv', 'id', (SELECT count(*) FROM (SELECT id FROM stg_ef "
       "WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1) u)"]
    + [nn("int_ohlcv_daily", "int_ef", c) for c in ("symbol", "date", "volume")]
    + [nn("fct_market_daily", "fct", c) for c in ("symbol", "date", "close")]
    + ["SELECT 'accepted_values', 'fct_market_daily', 'rsi_signal', count(*) FILTER (WHERE rsi_signal "
       "IS NOT NULL AND rsi_signal NOT IN ('oversold', 'overbought', 'neutral')) FROM fct",
       "SELECT 'accepted_values', 'fct_market_daily', 'bb_position', count(*) FILTER (WHERE bb_position "
       "IS NOT NULL AND bb_position NOT IN ('above_upper', 'below_lower', 'within_bands')) FROM fct",
       "SELECT 'assert_positive_volume', 'fct_market_daily', NULL, count(*) FILTER (WHERE volume < 0) FROM fct"])
ORACLE["q05_check_report"] = q([RAW_EF, STG_EF, DEF, INT_EF, indicators_sql("def", "symbol, exchange"), FCT_EF,
                                "rep AS (" + REPORT + ")"],
                               "SELECT check_name, table_name, column_name, failures, failures = 0 AS passed FROM rep",
                               [], True)

NOW = "TIMESTAMP '2024-01-30 12:00:00'"
BAD_MSG = "(event_id % 43 = 0 OR event_id % 37 = 0 OR event_id % 41 = 0 OR event_id % 47 = 0)"
DLQ = f"""dlq AS (
  SELECT 'raw_ohlcv' AS topic, CAST(user_id % 3 AS INTEGER) AS partition, event_id AS offset, ts AS timestamp,
         'parse_error' AS error_reason,
         CASE WHEN event_id % 43 = 0 THEN 'bad_encoding' WHEN event_id % 37 = 0 THEN 'invalid_json'
              WHEN event_id % 41 = 0 THEN 'missing_fields' ELSE 'bad_type' END AS reason_detail
  FROM events WHERE event_id % 89 != 0 AND {BAD_MSG})"""
ORACLE["q06_freshness"] = q([STG_E, DLQ], f"""
SELECT 'staging_stale' AS check_name, CAST(CASE WHEN max(ingested_at) IS NULL OR max(ingested_at) < {NOW} - INTERVAL 1 HOUR
       THEN 1 ELSE 0 END AS BIGINT) AS failures FROM stg_e
UNION ALL SELECT 'recent_rejects', count(*) FILTER (WHERE timestamp > {NOW} - INTERVAL 5 MINUTE AND timestamp <= {NOW}) FROM dlq
""".strip().replace("\n", " ").join(["SELECT check_name, failures, failures = 0 AS passed FROM (", ") f"]))

# ---------------------------------------------------------------- run log / monitoring
RUNS = """days AS (
  SELECT CAST(ingested_at AS DATE) AS day, min(ingested_at) AS started_at, max(ingested_at) AS finished_at,
         count(*) AS n,
         count(*) FILTER (WHERE high < low OR volume < 0 OR open <= 0 OR close <= 0) AS rejected
  FROM raw_e GROUP BY 1),
runs AS (
  SELECT 'run_' || strftime(day, '%Y%m%d') AS run_id, started_at, finished_at,
         CASE WHEN day = (SELECT max(day) FROM days) THEN NULL WHEN rejected > 10 THEN 'failed' ELSE 'success' END AS status,
         n - rejected AS rows_processed,
         CASE WHEN rejected > 10 THEN 'rejected ' || CAST(rejected AS VARCHAR) || ' rows' END AS error_message
  FROM days),
cur AS (
  SELECT 'candles_daily' AS dag_id, run_id, coalesce(status, 'running') AS status, started_at,
         CASE WHEN status IS NULL THEN NULL ELSE finished_at END AS finished_at,
         CASE WHEN status IS NULL THEN 0 ELSE rows_processed END AS rows_processed,
         CASE WHEN status IS NULL THEN NULL ELSE error_message END AS error_message
  FROM runs)"""
ORACLE["r01_run_start"] = q([RUNS], """SELECT 'candles_daily' AS dag_id, run_id, 'running' AS status,
  started_at AS event_at, started_at, CAST(NULL AS TIMESTAMP) AS finished_at, CAST(0 AS BIGINT) AS rows_processed,
  CAST(NULL AS VARCHAR) AS error_message FROM runs""")
ORACLE["r02_run_state"] = q([RUNS], "SELECT * FROM cur")
ORACLE["p09_run_status_code"] = q([RUNS], """SELECT run_id, status,
  CASE status WHEN 'success' THEN 1.0 WHEN 'running' THEN 0.5 ELSE 0.0 END::DOUBLE AS status_code FROM cur""",
                                  ["status_code"])
ORACLE["k04_latest_runs"] = q([RUNS], """SELECT started_at AS time, run_id,
  CASE status WHEN 'success' THEN 1.0 WHEN 'running' THEN 0.5 ELSE 0.0 END::DOUBLE AS status
FROM cur ORDER BY started_at DESC, run_id DESC LIMIT 10""", ["status"])

A08_STORAGE = """SELECT 'raw_ohlcv' AS table_name, count(*) AS row_count FROM raw_e
UNION ALL SELECT 'ohlcv_hourly', count(*) FROM (SELECT DISTINCT symbol, exchange, date_trunc('hour', epoch_ms(timestamp_ms)) FROM raw_e) h
UNION ALL SELECT 'ohlcv_daily', count(*) FROM (SELECT DISTINCT symbol, exchange, CAST(epoch_ms(timestamp_ms) AS DATE) FROM raw_e) d
UNION ALL SELECT 'technical_indicators', count(*) FROM (SELECT DISTINCT symbol, exchange, CAST(epoch_ms(timestamp_ms) AS DATE) FROM raw_e) i"""
ORACLE["a08_table_counts"] = q([RUNS], A08_STORAGE + " UNION ALL SELECT 'pipeline_runs', count(*) FROM cur")
ORACLE["a09_high_water_mark"] = q([], """SELECT symbol, max(timestamp_ms) AS last_timestamp_ms FROM raw_e GROUP BY symbol
UNION ALL SELECT 'UNKNOWN/PAIR', max(timestamp_ms) FROM raw_e WHERE symbol = 'UNKNOWN/PAIR'""")
ORACLE["a10_ingest_rate"] = q([], f"""SELECT date_trunc('hour', ingested_at) AS time, count(*) AS rows_ingested
FROM raw_e WHERE ingested_at > {NOW} - INTERVAL 24 HOUR GROUP BY 1""")
W5 = "make_timestamp(epoch_us(ts) // 300000000 * 300000000)"
ORACLE["a11_message_throughput"] = q([], f"""SELECT {W5} AS window_start, {W5} + INTERVAL 5 MINUTE AS window_end,
  CAST(user_id % 3 AS INTEGER) AS partition, count(*) AS messages, count(*) / 300.0 AS messages_per_sec
FROM events GROUP BY 1, 2, 3""", ["messages_per_sec"])
ORACLE["a11_dead_letter_counts"] = q([DLQ], "SELECT error_reason, reason_detail, count(*) AS messages FROM dlq GROUP BY 1, 2")
ORACLE["k01_latest_closes"] = q([DL], "SELECT date AS time, exchange, close FROM dl WHERE symbol = 'A/F' "
                                      "ORDER BY date DESC, exchange LIMIT 90", ["close"])
ORACLE["k02_latest_moving_averages"] = q([DL, indicators_sql("dl")],
                                         "SELECT date AS time, sma_7, sma_25, ema_12, ema_26 FROM ind WHERE symbol = 'A/F' "
                                         "ORDER BY date DESC LIMIT 90", ["sma_7", "sma_25", "ema_12", "ema_26"], True)
ORACLE["k03_latest_rsi"] = q([DL, indicators_sql("dl")],
                             "SELECT date AS time, rsi_14 FROM ind WHERE symbol = 'A/F' ORDER BY date DESC LIMIT 90",
                             ["rsi_14"], True)
ORACLE["p10_predicates"] = q([STG_E], f"SELECT id, symbol, candle_time, close FROM stg_e "
                                      f"WHERE candle_time > {NOW} - INTERVAL 24 HOUR AND symbol = 'click'", ["close"])
ORACLE["r03_daily_run"] = q([], """
SELECT 'raw_ohlcv' AS table_name, count(*) AS row_count FROM raw_l
UNION ALL SELECT 'ohlcv_hourly', count(*) FROM (SELECT DISTINCT symbol, exchange, date_trunc('hour', epoch_ms(timestamp_ms)) FROM raw_l) h
UNION ALL SELECT 'ohlcv_daily', count(*) FROM (SELECT DISTINCT symbol, exchange, CAST(epoch_ms(timestamp_ms) AS DATE) FROM raw_l) d
UNION ALL SELECT 'technical_indicators', count(*) FROM (SELECT DISTINCT symbol, CAST(epoch_ms(timestamp_ms) AS DATE) FROM raw_l) i
UNION ALL SELECT 'pipeline_runs', CAST(1 AS BIGINT)""")

# ---------------------------------------------------------------- sources
RAW_OUT = "id, symbol, exchange, timestamp_ms, open, high, low, close, volume"
RAW_DBL = ["open", "high", "low", "close", "volume"]
GOOD = f"event_id % 89 != 0 AND NOT {BAD_MSG}"
ORACLE["s01_read_table"] = q([], f"SELECT {RAW_OUT}, line, part FROM raw_l", RAW_DBL)
ORACLE["s02_write_table"] = q([], f"SELECT {RAW_OUT}, CAST(epoch_ms(timestamp_ms) AS DATE) AS candle_date FROM raw_e",
                              RAW_DBL)
ORACLE["s03_message_source"] = q([], "SELECT 'raw_ohlcv' AS topic, CAST(user_id % 3 AS INTEGER) AS partition, "
                                     "event_id AS offset FROM events WHERE event_id % 89 != 0")
# A staged row's id is its message's: offset (event_id) * 1024 + partition (user_id % 3).
STAGED_SQL = (f"SELECT r.id * 1024 + e.user_id % 3 AS id, {RAW_OUT.removeprefix('id, ')}, ingested_at "
              f"FROM raw_e r JOIN (SELECT event_id, user_id FROM events WHERE {GOOD}) e ON e.event_id = r.id")
ORACLE["s04_micro_batch_ingest"] = q([], STAGED_SQL, RAW_DBL)
ORACLE["t02_bounded_drain_replay"] = ORACLE["s04_micro_batch_ingest"]
ORACLE["t03_failed_flush_restart"] = ORACLE["s04_micro_batch_ingest"]
# The bytes of a rejected message: view E's record as JSON with its planted fault, two bytes before it for bad UTF-8.
MESSAGE_TEXT = """'{"symbol":"' || symbol || '","exchange":"' || exchange || '","timeframe":"1m","timestamp_ms":' || timestamp_ms
  || ',"open":' || CASE WHEN kind = 'bad_type' THEN '"abc"' ELSE CAST(open AS VARCHAR) END || ',"high":' || CAST(high AS VARCHAR)
  || ',"low":' || CAST(low AS VARCHAR) || ',"close":' || CAST(close AS VARCHAR)
  || CASE WHEN kind = 'missing_fields' THEN '' ELSE ',"volume":' || CAST(volume AS VARCHAR) END
  || ',"fetched_at":"' || strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00"}'"""
DLQ_BYTES = f"""texts AS (
  SELECT d.*, d.reason_detail AS kind, {MESSAGE_TEXT.replace("kind", "d.reason_detail")} AS text FROM dlq d JOIN raw_e ON id = d.offset),
dlq_bytes AS (
  SELECT *, CASE kind WHEN 'bad_encoding' THEN 'FFFE' || hex(text) WHEN 'invalid_json' THEN hex(text[:-2]) ELSE hex(text) END AS value_hex FROM texts)"""
ORACLE["t01_stream_dead_letters"] = q([DLQ, DLQ_BYTES], 'SELECT "offset", "partition", error_reason, reason_detail, value_hex FROM dlq_bytes')
ORACLE["s05_decode_messages"] = q([], f"""SELECT id AS offset, symbol, exchange, '1m' AS timeframe, timestamp_ms,
  open, high, low, close, volume FROM raw_e WHERE id IN (SELECT event_id FROM events WHERE {GOOD})""", RAW_DBL)
ORACLE["s06_dead_letters"] = q([DLQ, DLQ_BYTES], 'SELECT "offset", "partition", error_reason, reason_detail, value_hex, '
                                                 "'error_reason' AS header_key, 'parse_error' AS header_value FROM dlq_bytes")
LF = "lf AS (SELECT *, CAST(epoch_ms(timestamp_ms) AS DATE) AS day FROM raw_l)"
ORACLE["s07_insert_ignore"] = q([LF, "tgt AS (SELECT DISTINCT symbol, exchange, timestamp_ms FROM lf WHERE day < DATE '1998-01-01')",
                                 "b AS (SELECT *, row_number() OVER (PARTITION BY symbol, exchange, timestamp_ms "
                                 "ORDER BY timestamp_ms, id, line, part) AS rn FROM lf WHERE day >= DATE '1997-01-01')"],
                                f"SELECT {RAW_OUT}, line, part FROM b WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM tgt t "
                                "WHERE t.symbol = b.symbol AND t.exchange = b.exchange AND t.timestamp_ms = b.timestamp_ms)",
                                RAW_DBL)
ORACLE["j03_anti_join"] = q([LF, "tgt AS (SELECT DISTINCT symbol, exchange, timestamp_ms FROM lf WHERE day < DATE '1998-01-01')"],
                            f"SELECT {RAW_OUT}, line, part FROM lf b WHERE NOT EXISTS (SELECT 1 FROM tgt t "
                            "WHERE t.symbol = b.symbol AND t.exchange = b.exchange AND t.timestamp_ms = b.timestamp_ms)",
                            RAW_DBL)
ORACLE["s08_encode_messages"] = q([], """SELECT symbol || ':' || CAST(timestamp_ms AS VARCHAR) AS key, symbol, exchange,
  '1m' AS timeframe, timestamp_ms, open, high, low, close, volume, '' AS fetched_at FROM raw_e""", RAW_DBL)
ORACLE["s09_normalise_records"] = q([], """SELECT r.symbol, r.exchange,
  CASE WHEN e.user_id % 3 = 0 THEN '1m' ELSE '5m' END AS timeframe, r.timestamp_ms, r.open, r.high, r.low,
  r.close, r.volume,
  CASE WHEN e.user_id % 5 = 0 THEN '' ELSE strftime(r.ingested_at, '%Y-%m-%dT%H:%M:%S') END AS fetched_at
FROM raw_e r JOIN events e ON e.event_id = r.id""", RAW_DBL)
ORACLE["s10_newer_than_last"] = q([f"hw AS (SELECT symbol, max(timestamp_ms) AS m FROM raw_e WHERE ingested_at < "
                                   f"TIMESTAMP '2024-01-20 00:00:00' GROUP BY symbol)"],
                                  "SELECT r.id, r.symbol, r.timestamp_ms FROM raw_e r LEFT JOIN hw ON hw.symbol = r.symbol "
                                  "WHERE hw.m IS NULL OR r.timestamp_ms > hw.m")
ORACLE["s11_historical_load"] = q(["b AS (SELECT *, row_number() OVER (PARTITION BY symbol, exchange, timestamp_ms "
                                   "ORDER BY timestamp_ms, id, line, part) AS rn FROM raw_l)"],
                                  f"SELECT {RAW_OUT} FROM raw_e UNION ALL SELECT {RAW_OUT} FROM b WHERE rn = 1", RAW_DBL)
ORACLE["s12_array_to_record"] = q([], """SELECT symbol, exchange, '1m' AS timeframe, timestamp_ms, open, high, low,
  close, volume, '2024-02-01T00:00:00+00:00' AS fetched_at FROM raw_e""", RAW_DBL)
ORACLE["f01_f06_time_functions"] = q([], f"""SELECT id, timestamp_ms, epoch_ms(timestamp_ms) AS ts_exact,
  {CT} AS ts_seconds, date_trunc('hour', epoch_ms(timestamp_ms)) AS hour_start,
  CAST(epoch_ms(timestamp_ms) AS DATE) AS date,
  strftime(epoch_ms(timestamp_ms), '%Y-%m-%dT%H:%M:%S.%g+00:00') AS iso FROM raw_e""")
ORACLE["f07_f12_scalar_functions"] = q([], """SELECT r.id, abs(r.close - r.open) AS abs_move,
  greatest(r.high - r.low, abs(r.high - r.close)) AS range_max, sqrt(abs(r.volume)) AS sqrt_volume,
  -r.volume AS neg_volume, r.close / nullif(r.open, 0.0) AS close_over_open,
  coalesce(nullif(r.open, 0.0), r.close) AS open_or_close,
  CASE WHEN r.close >= r.open THEN 'up' ELSE 'down' END AS direction,
  r.symbol || ':' || CAST(r.timestamp_ms AS VARCHAR) AS msg_key,
  CAST(json_extract(e.props, '$.k') AS BIGINT) AS prop_k,
  r.open AS first_price, r.close AS last_price, CAST(r.volume AS BIGINT) AS volume_long,
  CAST(r.ingested_at AS DATE) AS ingest_date
FROM raw_e r JOIN events e ON e.event_id = r.id""", ["abs_move", "range_max", "sqrt_volume", "neg_volume",
                                                     "close_over_open", "open_or_close", "first_price",
                                                     "last_price"])
ORACLE["a02_daily_candles_incremental"] = ORACLE["a02_daily_candles"]
ORACLE["a02_daily_from_hourly_state"] = ORACLE["a02_daily_candles"]
ORACLE["w02_w13_macros_split_series"] = q([], """SELECT id, symbol, exchange,
  avg(close) OVER (PARTITION BY symbol, exchange ORDER BY timestamp_ms, id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS sma_5,
  stddev_samp(close) OVER (PARTITION BY symbol, exchange ORDER BY timestamp_ms, id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS std_20,
  lag(close, 1) OVER (PARTITION BY symbol, exchange ORDER BY timestamp_ms, id) AS close_lag_1,
  (close - lag(close, 1) OVER (PARTITION BY symbol, exchange ORDER BY timestamp_ms, id))
    / nullif(lag(close, 1) OVER (PARTITION BY symbol, exchange ORDER BY timestamp_ms, id), 0) AS pct_1
FROM raw_e""", ["sma_5", "std_20", "close_lag_1", "pct_1"])
ORACLE["w11_all_indicators_split_series"] = ORACLE["w11_all_indicators"]
COARSE = "CAST(1024 AS DOUBLE)"
ORACLE["w11_indicators_resumed"] = ORACLE["w11_all_indicators"].replace(GRID, COARSE)
ORACLE["s04_compacted_staging"] = ORACLE["s04_micro_batch_ingest"]
ORACLE["q06_failed_runs"] = q([RUNS], f"""SELECT 'failed_runs' AS check_name, n AS failures, n = 0 AS passed FROM (
  SELECT count(*) AS n FROM cur WHERE status = 'failed' AND finished_at > {NOW} - INTERVAL 20 DAY AND finished_at <= {NOW}) f""")
ORACLE["a08_health"] = q([RUNS, "counts AS (" + A08_STORAGE + ")",
                          f"bad AS (SELECT count(*) AS n, (SELECT count(*) FROM cur) AS runs FROM cur WHERE status = 'failed' "
                          f"AND finished_at > {NOW} - INTERVAL 20 DAY AND finished_at <= {NOW})"],
                         "SELECT 'storage' AS component, table_name, row_count, 'up' AS status, CAST(NULL AS VARCHAR) AS error FROM counts "
                         "UNION ALL SELECT 'runs', 'pipeline_runs', CASE WHEN n = 0 THEN runs END, CASE WHEN n = 0 THEN 'up' ELSE 'down' END, "
                         "CASE WHEN n > 0 THEN n || ' failed runs' END FROM bad "
                         "UNION ALL SELECT 'overall', NULL, NULL, CASE WHEN n = 0 THEN 'up' ELSE 'down' END, "
                         "CASE WHEN n > 0 THEN '1 of 5 components down' END FROM bad")
STAGED_E = f"staged AS ({STAGED_SQL})"
STG_S = STG_E.replace("raw_e", "staged").replace("stg_e AS", "stg_s AS", 1)
INT_S = INT_E.replace("stg_e", "stg_s").replace("int_e AS", "int_s AS", 1)
DS = "ds AS (" + candle_sql("staged", "day", "timestamp_ms, id") + ")"
ORACLE["r03_incremental_run"] = q([STAGED_E, STG_S, INT_S, DS, indicators_sql("ds", "symbol, exchange")], """SELECT d.symbol, d.exchange, d.date, d.open, d.close, d.volume,
  d.candle_count, i.sma_25, i.ema_26, i.macd_signal, i.obv,
  CASE WHEN i.rsi_14 < 30 THEN 'oversold' WHEN i.rsi_14 > 70 THEN 'overbought' ELSE 'neutral' END AS rsi_signal
FROM int_s d LEFT JOIN ind i ON i.symbol = d.symbol AND i.exchange = d.exchange AND i.date = d.date""",
                                  ["open", "close", "volume", "sma_25", "ema_26", "macd_signal", "obv"], True)
