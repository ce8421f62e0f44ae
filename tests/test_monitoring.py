import datetime as dt

from pyspark.sql import functions as F

from barline.plans import monitoring as MON
from barline.plans import quality as Q

EV = "ingested_at timestamp, symbol string, close double, date date, exchange string"


def _now():
    return F.lit(dt.datetime(2024, 1, 2, 12, 0))


def test_health_rows_of_frames(spark):
    t = {"raw_ohlcv": spark.range(5), "ohlcv_daily": spark.range(2)}
    rows = {r["table_name"]: (r["row_count"], r["status"]) for r in MON.health(spark, t).collect() if r["table_name"]}
    assert rows == {"raw_ohlcv": (5, "up"), "ohlcv_daily": (2, "up")}


def test_ingest_rate_last_24h(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 11, 5),), (dt.datetime(2024, 1, 2, 11, 50),),
                                (dt.datetime(2024, 1, 1, 11, 0),)], "ingested_at timestamp")
    got = [(r["time"], r["rows_ingested"]) for r in MON.ingest_rate(df, _now()).collect()]
    assert got == [(dt.datetime(2024, 1, 2, 11, 0), 2)]


def test_throughput_windows(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 1), 0), (dt.datetime(2024, 1, 1, 0, 4), 0),
                                (dt.datetime(2024, 1, 1, 0, 6), 1)], "timestamp timestamp, partition int")
    got = sorted((r["window_start"].minute, r["partition"], r["messages"])
                 for r in MON.message_throughput(df).collect())
    assert got == [(0, 0, 2), (5, 1, 1)]


def test_freshness(spark):
    staging = spark.createDataFrame([(dt.datetime(2024, 1, 2, 10, 0),)], "ingested_at timestamp")
    dlq = spark.createDataFrame([(dt.datetime(2024, 1, 2, 11, 58),)], "timestamp timestamp")
    got = {r["check_name"]: r["failures"] for r in Q.freshness(staging, dlq, _now()).collect()}
    assert got == {"staging_stale": 1, "recent_rejects": 1}


def test_latest_closes_top90_with_exchange_tiebreak(spark):
    rows = [("A", "b", dt.date(2024, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(100)]
    rows += [("A", "a", dt.date(2024, 4, 9), -1.0)]
    df = spark.createDataFrame(rows, "symbol string, exchange string, date date, close double")
    got = MON.latest_closes(df, "A").collect()
    assert len(got) == 90 and got[0]["exchange"] == "a" and got[1]["exchange"] == "b"
