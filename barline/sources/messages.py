"""Candle messages: encode (S08), decode and validate (S05), dead-letter
routing (S06), record normalisation (S09) and exchange arrays (S12).

All of it is column expressions on the message envelope (the shape of Spark's
Kafka source): no per-row Python.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.schemas import CANDLE_MESSAGE, OPTIONAL_DEFAULTS, REQUIRED_FIELDS

# The dead-letter header name and the reason the reference
# writes for every reject, plus our finer reasons.
DLQ_HEADER = "error_reason"
DLQ_REASON = "parse_error"
REASON_ENCODING = "bad_encoding"
REASON_JSON = "invalid_json"
REASON_MISSING = "missing_fields"
REASON_NULL = "null_field"
REASON_TYPE = "bad_type"
REASON_RANGE = "bad_range"

# Epoch milliseconds that Spark's timestamps (microseconds in a long) can hold.
MAX_EPOCH_MS = (2 ** 63 - 1) // 1000

_TYPES = {f.name: f.dataType.simpleString() for f in CANDLE_MESSAGE.fields}
_NUMERIC = ("timestamp_ms", "open", "high", "low", "close", "volume")


def message_key(symbol="symbol", timestamp_ms="timestamp_ms") -> Column:
    """``{symbol}:{timestamp_ms}``."""
    return F.concat_ws(":", F.col(symbol), F.col(timestamp_ms).cast("string"))


def encode_messages(records: DataFrame, topic: str = "raw_ohlcv",
                    fields: Sequence[str] = tuple(_TYPES)) -> DataFrame:
    """key = ``symbol:timestamp_ms`` bytes, value = JSON of the record bytes
    with every field, NULL ones as ``null``. All ``fields`` must be there (S09 adds
    the optional ones)."""
    return records.select(
        F.encode(message_key(), "UTF-8").alias("key"),
        F.encode(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), "UTF-8").alias("value"),
        F.lit(topic).alias("topic"))


def publish_messages(records: DataFrame, format: str = "kafka", options: Mapping[str, str] | None = None,  # noqa: A002
                     topic: str = "raw_ohlcv") -> None:
    """S08 to a sink by format name: normalised (S09) and encoded records, appended.
    For ``kafka`` give ``kafka.bootstrap.servers`` in ``options``; the key deals
    messages to partitions by symbol and time."""
    encoded = encode_messages(normalise_records(records), topic)
    encoded.write.format(format).options(**dict(options or {})).mode("append").save()


_AS_TEXT = "struct<" + ",".join(f"{f}:string" for f in _TYPES) + ">"


def parse_messages(envelope: DataFrame, value: str = "value", require_values: bool = True) -> DataFrame:
    """S05 + S06 in one projection.

    Adds ``reason`` (NULL for a good message) and the typed record fields.
    The value must be UTF-8 and exactly one JSON object carrying the eight
    required keys; a repeated key keeps its last value (as a JSON object decoder
    does). The text is read as the only element of an array, which shows a
    second object, text after the object and single quotes. (``{..}] }`` is the
    one malformed form still read as its object.) With ``require_values`` a
    required JSON null is ``null_field``: staging columns are NOT NULL, and a
    NULL key would defeat insert-ignore; without it presence alone is checked,
    as the reference's decoder does. A present value that does not cast to its
    type is ``bad_type`` (X7), a time that no timestamp can hold ``bad_range``;
    a whole time written as a decimal (``1704067200000.0``) is a time.
    Tombstones (NULL value) are not messages and must be filtered first (S03).
    """
    # One step a projection, so that each is evaluated once and its generated
    # method stays small enough for the JIT: text, parse, fields, typed fields,
    # reason. The key listing (a second parse) is needed only when a required
    # field came back NULL -- absent, JSON null, or not an object at all -- and
    # CASE evaluates it lazily, so a good message is parsed once.
    cols = envelope.columns
    text = F.try_validate_utf8(F.col(value).cast("string"))
    step = envelope.select(*cols, text.alias("_text"))
    whole = F.concat(F.lit("["), F.col("_text"), F.lit("]"))
    step = step.select(*cols, "_text", F.from_json(whole, f"array<{_AS_TEXT}>", {"allowSingleQuotes": "false"}).alias("_v"))
    bare = F.trim(F.translate("_text", "\t\r\n", "   "))
    single = (F.size("_v") == 1) & bare.startswith("{") & bare.endswith("}")
    step = step.select(*cols, "_text", single.alias("_single"), F.get("_v", F.lit(0)).alias("_m"))
    raw = {f: F.col("_m")[f] for f in _TYPES}
    typed = {f: raw[f].try_cast(_TYPES[f]) if f in _NUMERIC else raw[f] for f in _TYPES}
    typed["timestamp_ms"] = raw["timestamp_ms"].try_cast("decimal(38,9)").try_cast("bigint")
    step = step.select(*cols, "_text", "_single", "_m", *[x.alias(f"_t_{f}") for f, x in typed.items()])
    some_null, bad_type = F.lit(False), F.lit(False)
    for f in REQUIRED_FIELDS:
        some_null = some_null | raw[f].isNull()
    for f in _NUMERIC:
        bad_type = bad_type | (raw[f].isNotNull() & F.col(f"_t_{f}").isNull())
    step = step.select(*cols, "_text", "_single", some_null.alias("_some_null"), bad_type.alias("_bad_type"), *[f"_t_{f}" for f in _TYPES])
    keys = F.json_object_keys("_text")
    required = F.array(*[F.lit(f) for f in REQUIRED_FIELDS])
    reason = (F.when(F.col("_text").isNull(), REASON_ENCODING)
              .when(~F.coalesce("_single", F.lit(False)) | (F.col("_some_null") & keys.isNull()), REASON_JSON)
              .when(F.col("_some_null") & (F.size(F.array_except(required, keys)) > 0), REASON_MISSING)
              .when(F.col("_some_null") & F.lit(require_values), REASON_NULL)
              .when(F.col("_bad_type"), REASON_TYPE)
              .when((F.col("_t_timestamp_ms") > MAX_EPOCH_MS) | (F.col("_t_timestamp_ms") < -MAX_EPOCH_MS), REASON_RANGE))
    # The parse result leaves through a one-element ``inline`` generator: a
    # filter on its columns (good vs rejected) cannot be pushed below a
    # generator, so Catalyst does not re-inline the whole decode into the scan
    # predicate (which parsed every message twice, in an interpreted Filter).
    result = F.struct(reason.alias("reason"), *[F.col(f"_t_{f}").alias(f) for f in _TYPES])
    return step.select(*cols, F.inline(F.array(result)))


def valid_records(parsed: DataFrame) -> DataFrame:
    """S05 output: the good messages as candle records."""
    return parsed.filter(F.col("reason").isNull())


def dead_letters(parsed: DataFrame,
                 keep: Sequence[str] = ("topic", "partition", "offset", "timestamp")) -> DataFrame:
    """Rejects with the original bytes and the ``error_reason`` header.

    The header carries the reference's single reason; ``reason_detail`` the
    finer one. ``keep`` columns (topic/partition/offset) make the dead-letter
    table idempotent under replay.
    """
    k = [c for c in keep if c in parsed.columns]
    return parsed.filter(F.col("reason").isNotNull()).select(
        *k, "key", "value",
        F.array(F.struct(F.lit(DLQ_HEADER).alias("key"),
                         F.encode(F.lit(DLQ_REASON), "UTF-8").alias("value"))).alias("headers"),
        F.lit(DLQ_REASON).alias("error_reason"), F.col("reason").alias("reason_detail"))


def normalise_records(df: DataFrame) -> DataFrame:
    """Cast to long/double/string; ``timeframe`` defaults to '1m' and
    ``fetched_at`` to '' when absent or NULL."""
    out = []
    for f in CANDLE_MESSAGE.fields:
        if f.name in df.columns:
            c = F.col(f.name).cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        if f.name in OPTIONAL_DEFAULTS:
            c = F.coalesce(c, F.lit(OPTIONAL_DEFAULTS[f.name]))
        out.append(c.alias(f.name))
    return df.select(*out)


def records_from_arrays(df: DataFrame, symbol: str, exchange: str, timeframe: str = "1m",
                        candle: str = "candle", fetched_at: Column | None = None) -> DataFrame:
    """Exchange rows ``[ts, open, high, low, close, volume]`` -> records.

    ``fetched_at`` defaults to the current UTC time as an ISO-8601 string.
    """
    c = F.col(candle)
    fa = fetched_at if fetched_at is not None else \
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    sym = F.col(symbol) if symbol in df.columns else F.lit(symbol)
    exc = F.col(exchange) if exchange in df.columns else F.lit(exchange)
    return df.select(
        sym.alias("symbol"), exc.alias("exchange"), F.lit(timeframe).alias("timeframe"),
        c[0].cast("long").alias("timestamp_ms"), c[1].cast("double").alias("open"),
        c[2].cast("double").alias("high"), c[3].cast("double").alias("low"),
        c[4].cast("double").alias("close"), c[5].cast("double").alias("volume"),
        fa.alias("fetched_at"))


#: Bound on a topic's partitions; part of every row id, so fixed for the life of a staging table.
TOPIC_PARTITIONS = 1024


def message_id(partition: str = "partition", offset: str = "offset") -> Column:
    """A row id unique over the topic and the same on every replay."""
    return F.col(offset).cast("long") * TOPIC_PARTITIONS + F.col(partition)


def to_raw_rows(records: DataFrame, row_id: Column, ingested_at: Column | None = None) -> DataFrame:
    """Records -> ``raw_ohlcv`` rows (``timeframe``/``fetched_at`` dropped at staging)."""
    ing = ingested_at if ingested_at is not None else F.current_timestamp()
    return records.select(
        row_id.cast("long").alias("id"), "symbol", "exchange", "timestamp_ms",
        "open", "high", "low", "close", "volume", ing.alias("ingested_at"))
