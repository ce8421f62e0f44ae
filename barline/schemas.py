"""Table and message schemas (one StructType per table)."""

from __future__ import annotations

from pyspark.sql import types as T

# The eight fields a candle message must carry, and the two
# optional ones with their defaults.
REQUIRED_FIELDS = ("symbol", "exchange", "timestamp_ms", "open", "high", "low", "close", "volume")
OPTIONAL_DEFAULTS = {"timeframe": "1m", "fetched_at": ""}
PRICE_FIELDS = ("open", "high", "low", "close", "volume")

CANDLE_MESSAGE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("exchange", T.StringType()),
    T.StructField("timeframe", T.StringType()),
    T.StructField("timestamp_ms", T.LongType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("fetched_at", T.StringType()),
])

# The shape Spark's Kafka source gives, plus headers (used for dead letters).
MESSAGE_ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

HEADER = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])

DEAD_LETTER = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("headers", T.ArrayType(HEADER)),
    T.StructField("error_reason", T.StringType()),
    T.StructField("reason_detail", T.StringType()),
])

RAW_OHLCV = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("symbol", T.StringType(), False),
    T.StructField("exchange", T.StringType(), False),
    T.StructField("timestamp_ms", T.LongType(), False),
    T.StructField("open", T.DoubleType(), False),
    T.StructField("high", T.DoubleType(), False),
    T.StructField("low", T.DoubleType(), False),
    T.StructField("close", T.DoubleType(), False),
    T.StructField("volume", T.DoubleType(), False),
    T.StructField("ingested_at", T.TimestampType(), False),
])
RAW_COLUMNS = tuple(f.name for f in RAW_OHLCV.fields)
CANDLE_KEY = ("symbol", "exchange", "timestamp_ms")

CANDLE_COLUMNS = ("open", "high", "low", "close", "volume", "trade_count", "vwap")

INDICATOR_COLUMNS = (
    "sma_7", "sma_25", "sma_99", "ema_12", "ema_26", "rsi_14", "macd", "macd_signal",
    "macd_histogram", "bb_upper", "bb_middle", "bb_lower", "atr_14", "obv",
)

PIPELINE_RUN_EVENT = T.StructType([
    T.StructField("dag_id", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("event_at", T.TimestampType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("finished_at", T.TimestampType()),
    T.StructField("rows_processed", T.LongType()),
    T.StructField("error_message", T.StringType()),
])
