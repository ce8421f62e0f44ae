"""Raw candle tables derived from the driver's test tables.

The test tables hold no market candles, so two raw ``raw_ohlcv``-shaped views
are derived from them by plain column expressions (the DuckDB oracle writes the
same expressions in SQL):

* **E** from ``events``: 5 symbols (``event_type``), two exchanges, one candle
  per event, with planted faults (swapped high/low, negative volume, zero open)
  so that the quality flags and checks have something to find.
* **L** from ``lineitem``: 6 symbols (``returnflag/linestatus``), one exchange,
  several candles per symbol and day over ~7 years: long daily series for the
  indicators. Candles of one day share ``timestamp_ms``; the tie-break columns
  ``id, line, part`` make first/last deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the derivation (shared with the oracle SQL).
EXCHANGES_E = ("ex_a", "ex_b")
SWAP_HL_EVERY = 97
NEGATE_VOLUME_EVERY = 101
ZERO_OPEN_EVERY = 103
EXCHANGE_L = "x"

E_ORDER = ("timestamp_ms", "id")
L_ORDER = ("timestamp_ms", "id", "line", "part")
# Declared widths of L's order columns, so the four pack into one 126-bit key.
L_BITS = {"timestamp_ms": 44, "id": 40, "line": 8, "part": 34}


def read_test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def candles_from_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """View E: one raw candle per event (unfiltered, faults included).

    ``keep`` passes further ``events`` columns through (no join needed)."""
    eid = F.col("event_id")
    base_open = F.col("value")
    base_close = F.col("value") + ((eid % 11) - 5).cast("double") * F.lit(0.25)
    hi = F.greatest(base_open, base_close) + F.lit(0.5)
    lo = F.least(base_open, base_close) - F.lit(0.5)
    swap = (eid % SWAP_HL_EVERY) == 0
    vol = (F.lit(1) + F.col("user_id") % 50).cast("double")
    ts = F.col("ts").cast("timestamp")
    return events.select(
        eid.alias("id"),
        F.col("event_type").alias("symbol"),
        F.when(F.col("user_id") % 2 == 0, EXCHANGES_E[0]).otherwise(EXCHANGES_E[1]).alias("exchange"),
        F.unix_millis(ts).alias("timestamp_ms"),
        F.when(eid % ZERO_OPEN_EVERY == 0, F.lit(0.0)).otherwise(base_open).alias("open"),
        F.when(swap, lo).otherwise(hi).alias("high"),
        F.when(swap, hi).otherwise(lo).alias("low"),
        base_close.alias("close"),
        F.when(eid % NEGATE_VOLUME_EVERY == 0, -vol).otherwise(vol).alias("volume"),
        ts.alias("ingested_at"),
        *keep,
    )


def candles_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """View L: one raw candle per line item, price = extended price / quantity."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    ts = F.col("l_shipdate").cast("timestamp")
    return lineitem.select(
        F.col("l_orderkey").alias("id"),
        F.concat_ws("/", "l_returnflag", "l_linestatus").alias("symbol"),
        F.lit(EXCHANGE_L).alias("exchange"),
        F.unix_millis(ts).alias("timestamp_ms"),
        price.alias("open"),
        (price + F.lit(0.5)).alias("high"),
        (price - F.lit(0.5)).alias("low"),
        price.alias("close"),
        F.col("l_quantity").alias("volume"),
        ts.alias("ingested_at"),
        F.col("l_linenumber").cast("long").alias("line"),
        F.col("l_partkey").alias("part"),
    )


def raw_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candles_from_events(read_test_table(spark, sf_dir, "events"))


def raw_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candles_from_lineitem(read_test_table(spark, sf_dir, "lineitem"))


# Planted faults of the message view (checked in this order).
TOMBSTONE_EVERY = 89
BAD_UTF8_EVERY = 43
BAD_JSON_EVERY = 37
MISSING_FIELD_EVERY = 41
BAD_TYPE_EVERY = 47
MESSAGE_PARTITIONS = 3
TOPIC = "raw_ohlcv"


def messages_from_events(events: DataFrame) -> DataFrame:
    """Message envelope view M over ``events``: one candle message per event
    (the record of view E as JSON), ``partition = user_id % 3``,
    ``offset = event_id``, with planted tombstones and bad payloads."""
    e = candles_from_events(events, keep=("user_id",))
    eid = F.col("id")
    fields = {"symbol": F.col("symbol"), "exchange": F.col("exchange"),
              "timeframe": F.lit("1m"),
              **{c: F.col(c) for c in ("timestamp_ms", "open", "high", "low", "close", "volume")},
              "fetched_at": F.date_format("ingested_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")}

    def record(overrides: dict, drop: tuple = ()) -> Column:
        return F.to_json(F.struct(*[overrides.get(n, c).alias(n) for n, c in fields.items()
                                    if n not in drop]))
    good = record({})
    no_volume = record({}, drop=("volume",))
    bad_type = record({"open": F.lit("abc")})
    text = (F.when(eid % BAD_JSON_EVERY == 0, F.expr("substring(_good, 1, length(_good) - 1)"))
            .when(eid % MISSING_FIELD_EVERY == 0, no_volume)
            .when(eid % BAD_TYPE_EVERY == 0, bad_type)
            .otherwise(F.col("_good")))
    value = (F.when(eid % TOMBSTONE_EVERY == 0, F.lit(None).cast("binary"))
             .when(eid % BAD_UTF8_EVERY == 0, F.concat(F.unhex(F.lit("FFFE")), F.encode("_good", "UTF-8")))
             .otherwise(F.encode(text, "UTF-8")))
    # Each JSON text is built in its own projection, then referenced by name.
    return e.select("*", good.alias("_good")).select(
        F.encode(F.concat_ws(":", "symbol", F.col("timestamp_ms").cast("string")), "UTF-8").alias("key"),
        value.alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("user_id") % MESSAGE_PARTITIONS).cast("int").alias("partition"),
        eid.alias("offset"),
        F.col("ingested_at").alias("timestamp"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from_events(read_test_table(spark, sf_dir, "events"))


# Key faults of the quality-check copy of view E.
NULL_SYMBOL_EVERY = 211
DUPLICATE_ID_EVERY = 199


def with_key_faults(raw: DataFrame) -> DataFrame:
    """Copy of a raw view with NULL symbols and duplicated ids planted, for
    the not_null / unique checks (clean data would give nothing to find)."""
    return raw.select(
        F.when(F.col("id") % DUPLICATE_ID_EVERY == 0, F.col("id") - 1).otherwise(F.col("id")).alias("id"),
        F.when(F.col("id") % NULL_SYMBOL_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(F.col("symbol")).alias("symbol"),
        *[c for c in raw.columns if c not in ("id", "symbol")]).select(*raw.columns)


# The run-log view (one run per day of events).
DAG_ID = "candles_daily"
FAILED_REJECTS = 10


def runs_from_raw(raw: DataFrame) -> DataFrame:
    """One pipeline run per day of a raw view: start/end = first/last ingest
    time, rows = clean rows, ``failed`` when more than 10 rows were rejected;
    the latest day's run has not finished (``status`` NULL)."""
    from barline.operators.staging import with_quality_flags
    flagged = with_quality_flags(raw).withColumn("day", F.to_date("ingested_at"))
    bad = F.col("is_invalid_hl") | F.col("is_negative_volume") | F.col("is_zero_price")
    per_day = flagged.groupBy("day").agg(
        F.min("ingested_at").alias("started_at"), F.max("ingested_at").alias("finished_at"),
        F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("rejected"))
    last_day = per_day.agg(F.max("day")).scalar()   # scalar subquery, one value
    failed = F.col("rejected") > FAILED_REJECTS
    return per_day.select(
        F.concat(F.lit("run_"), F.date_format("day", "yyyyMMdd")).alias("run_id"),
        "started_at", "finished_at",
        F.when(F.col("day") == last_day, F.lit(None).cast("string"))
        .when(failed, "failed").otherwise("success").alias("status"),
        (F.col("n") - F.col("rejected")).alias("rows_processed"),
        F.when(failed, F.concat(F.lit("rejected "), F.col("rejected").cast("string"), F.lit(" rows")))
        .alias("error_message"))
