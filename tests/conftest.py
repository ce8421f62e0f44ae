import os
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from barline.session import build_session
    s = build_session("local[*]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own shared folder only when the session has none.
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="barline-test-"))
    yield s


@pytest.fixture
def three_candles(spark):
    """Two candles at 09:xx and one at 11:xx of 2023-06-15, prices falling."""
    nine = 1686819600000  # 2023-06-15 09:00 UTC
    return spark.createDataFrame(
        [(31, "SOL/EUR", "desk", nine + 5 * 60_000, 8.0, 9.5, 7.75, 9.0, 12.0),
         (32, "SOL/EUR", "desk", nine + 40 * 60_000, 9.0, 9.25, 7.25, 7.5, 4.0),
         (33, "SOL/EUR", "desk", nine + 125 * 60_000, 7.5, 7.75, 6.5, 7.0, 5.0)],
        "id long, symbol string, exchange string, timestamp_ms long, open double, high double, low double, "
        "close double, volume double")


@pytest.fixture
def twenty_days(spark):
    """Closes climb by 2 for 15 days (100, 102, ... 128), then fall by 3 for 5."""
    return (spark.range(20).select(
        F.lit("SOL/EUR").alias("symbol"), F.lit("desk").alias("exchange"),
        F.date_add(F.lit("2023-03-01").cast("date"), F.col("id").cast("int")).alias("date"),
        F.when(F.col("id") < 15, 100.0 + 2 * F.col("id")).otherwise(128.0 - 3 * (F.col("id") - 14)).alias("close"),
        (10.0 + F.col("id")).alias("volume"))
        .selectExpr("symbol", "exchange", "date", "close - 1 AS open", "close + 4 AS high", "close - 6 AS low", "close", "volume"))
