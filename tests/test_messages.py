import json

from pyspark.sql import functions as F

from barline.schemas import MESSAGE_ENVELOPE
from barline.sources import messages as MSG

CANDLE = {"symbol": "BTC/USDT", "exchange": "binance", "timestamp_ms": 1704067200000,
          "open": 42000.0, "high": 42100.0, "low": 41900.0, "close": 42050.0, "volume": 123.45}


def envelope(spark, values):
    rows = [(None, v, "raw_ohlcv", 0, i, None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, MESSAGE_ENVELOPE)


def test_parse_good_and_bad(spark):
    extra = dict(CANDLE, extra_field="kept")
    vals = [json.dumps(CANDLE).encode(), b"not json", json.dumps({"symbol": "X", "open": 1}).encode(),
            b"\xff\xfe", json.dumps(extra).encode(), json.dumps(dict(CANDLE, open="abc")).encode()]
    p = MSG.parse_messages(envelope(spark, vals)).orderBy("offset").collect()
    assert [r["reason"] for r in p] == [None, "invalid_json", "missing_fields", "bad_encoding",
                                        None, "bad_type"]
    assert p[0]["close"] == 42050.0 and p[0]["timestamp_ms"] == 1704067200000
    assert p[0]["timeframe"] is None


def test_presence_not_nullness(spark):
    v = json.dumps(dict(CANDLE, volume=None)).encode()
    r = MSG.parse_messages(envelope(spark, [v]), require_values=False).collect()[0]
    assert r["reason"] is None and r["volume"] is None
    assert MSG.parse_messages(envelope(spark, [v])).collect()[0]["reason"] == "null_field"


def test_only_one_whole_json_object(spark):
    text = json.dumps(CANDLE)
    bad = [text + " trailing", text + text, text.replace('"', "'"), text + "," + text, "[" + text + "]", text + "]", text + "] x", ""]
    got = MSG.parse_messages(envelope(spark, [b.encode() for b in bad] + [f"\n {text}\t\r\n".encode()])).orderBy("offset").collect()
    assert [r["reason"] for r in got] == ["invalid_json"] * len(bad) + [None]


def test_times(spark):
    times = ["1704067200000.0", "9223372036854775807", "-9223372036854775808", "9223372036854775", "1e400", "true"]
    vals = [json.dumps(CANDLE).replace("1704067200000", t).encode() for t in times]
    got = MSG.parse_messages(envelope(spark, vals)).orderBy("offset").collect()
    assert [r["reason"] for r in got] == [None, "bad_range", "bad_range", None, "bad_type", "bad_type"]
    assert got[0]["timestamp_ms"] == 1704067200000


def test_encode_keeps_null_fields(spark):
    df = spark.createDataFrame([dict(CANDLE, volume=None)], "symbol string, exchange string, timestamp_ms long, open double, high double, "
                                                            "low double, close double, volume double")
    value = bytes(MSG.encode_messages(MSG.normalise_records(df)).first()["value"]).decode()
    assert json.loads(value) == dict(CANDLE, volume=None, timeframe="1m", fetched_at="")


def test_default_fetched_at_has_a_numeric_offset(spark):
    df = spark.createDataFrame([([1.0, 1.0, 2.0, 0.5, 1.5, 10.0],)], "candle array<double>")
    assert MSG.records_from_arrays(df, "S", "x").first()["fetched_at"].endswith("+00:00")


def test_ids_differ_between_partitions(spark):
    df = spark.range(3).selectExpr("cast(id as int) partition", "0L offset").select(MSG.message_id().alias("id"))
    assert sorted(r[0] for r in df.collect()) == [0, 1, 2]


def test_dead_letters_keep_bytes_and_header(spark):
    p = MSG.parse_messages(envelope(spark, [b"{bad"]))
    d = MSG.dead_letters(p).collect()[0]
    assert bytes(d["value"]) == b"{bad"
    assert d["headers"][0]["key"] == "error_reason" and bytes(d["headers"][0]["value"]) == b"parse_error"


def test_encode_key_and_roundtrip(spark):
    df = spark.createDataFrame([dict(CANDLE, timeframe="1m", fetched_at="")])
    e = MSG.encode_messages(df).collect()[0]
    assert bytes(e["key"]) == b"BTC/USDT:1704067200000"
    assert json.loads(bytes(e["value"]))["close"] == 42050.0


def test_normalise_string_typed(spark):
    df = spark.createDataFrame([{k: str(v) for k, v in CANDLE.items()}])
    r = MSG.normalise_records(df).collect()[0]
    assert r["timestamp_ms"] == 1704067200000 and r["volume"] == 123.45
    assert r["timeframe"] == "1m" and r["fetched_at"] == ""


def test_records_from_arrays(spark):
    df = spark.createDataFrame([([1704067200000.0, 1.0, 2.0, 0.5, 1.5, 10.0],)], "candle array<double>")
    r = MSG.records_from_arrays(df, "BTC/USDT", "binance", fetched_at=F.lit("t")).collect()[0]
    assert (r["symbol"], r["timestamp_ms"], r["low"], r["volume"]) == ("BTC/USDT", 1704067200000, 0.5, 10.0)


def test_repeated_key_keeps_last_and_arrays_are_invalid(spark):
    dup = b'{"symbol":"A","symbol":"B","exchange":"x","timestamp_ms":1,"open":1,"high":1,"low":1,"close":1,"volume":1}'
    p = MSG.parse_messages(envelope(spark, [dup, b"[1, 2]", b"null"])).orderBy("offset").collect()
    assert p[0]["reason"] is None and p[0]["symbol"] == "B"
    assert [r["reason"] for r in p[1:]] == ["invalid_json", "invalid_json"]


def test_publish_to_a_sink_by_format(spark):
    from barline.session import work_path
    path = work_path(spark, "topic")
    df = spark.createDataFrame([CANDLE, dict(CANDLE, symbol="ETH/USDT")])
    for _ in range(2):
        MSG.publish_messages(df, "parquet", {"path": path}, topic="t")
    got = spark.read.parquet(path)
    assert got.columns == ["key", "value", "topic"] and got.count() == 4
    assert {bytes(r["key"]).decode() for r in got.collect()} == {"BTC/USDT:1704067200000", "ETH/USDT:1704067200000"}
    assert json.loads(bytes(got.first()["value"]))["timeframe"] == "1m"
