import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from barline.operators.dedupe import in_batch_range
from barline.plans.registry import QUERIES, message_files
from barline.session import work_path
from barline.streaming.ingest import drain, read_staging

SF = "/root/testdata/sf0.001"


def test_replay_and_restart_give_the_same_table(spark):
    once = QUERIES["s04_micro_batch_ingest"](spark, SF)
    replay = QUERIES["t02_bounded_drain_replay"](spark, SF)
    restart = QUERIES["t03_failed_flush_restart"](spark, SF)
    n = once.count()
    assert n > 0
    for other in (replay, restart):
        assert other.count() == n
        assert once.exceptAll(other).count() == 0
    keys = once.groupBy("symbol", "exchange", "timestamp_ms").count().filter("count > 1")
    assert keys.count() == 0


def test_continuous_consumer_on_file_source(spark):
    from barline.plans.registry import message_files
    from barline.session import work_path
    from barline.streaming.ingest import start_consumer
    src = message_files(spark, SF)
    base = work_path(spark, "consumer")
    q = start_consumer(spark, f"{base}/staging", f"{base}/dlq", f"{base}/ck", source_format="parquet",
                       source=src, interval="1 second", ingested_at="timestamp")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    once = QUERIES["s04_micro_batch_ingest"](spark, SF)
    got = read_staging(spark, f"{base}/staging").select(*once.columns)
    assert got.count() == once.count() > 0


def test_failed_batch_leaves_staging_incomplete_until_restart(spark):
    src, base = message_files(spark, SF), work_path(spark, "restart")

    def fail_in_second(batch_id):
        if batch_id == 1:
            raise RuntimeError("injected failure")
    args = (spark, src, f"{base}/ck", f"{base}/staging", f"{base}/dlq")
    kw = dict(source_options={"maxFilesPerTrigger": "1"}, ingested_at="timestamp")
    with pytest.raises(StreamingQueryException, match="injected failure"):
        drain(*args, **kw, before_batch=fail_in_second)
    partial = read_staging(spark, f"{base}/staging").count()
    drain(*args, **kw)
    whole = read_staging(spark, f"{base}/staging").count()
    assert 0 < partial < whole == QUERIES["s04_micro_batch_ingest"](spark, SF).count()


def test_dead_letters_are_read_by_offset_range(spark):
    path = work_path(spark, "range")
    spark.range(100).selectExpr("id AS offset").union(spark.sql("SELECT CAST(NULL AS BIGINT)")).write.parquet(path)
    batch = spark.createDataFrame([(10,), (12,)], "offset long")
    kept = in_batch_range(spark.read.parquet(path), batch, "offset")
    assert sorted(r[0] for r in kept.collect() if r[0] is not None) == [10, 11, 12] and kept.count() == 4


def test_a_large_message_file_is_shared_by_the_tasks_of_its_batch(spark, tmp_path):
    (spark.range(300_000).selectExpr(
        "id AS event_id", "timestamp_seconds(1704067200 + id) AS ts", "id % 1500 AS user_id", "'view' AS event_type",
        "CAST(id % 1000 AS DOUBLE) AS value", "CAST(NULL AS STRING) AS props").write.parquet(f"{tmp_path}/events.parquet"))
    src = message_files(spark, str(tmp_path))
    files = spark.read.parquet(src).groupBy(F.col("_metadata.file_path").alias("file")).count().collect()
    assert len(files) == 4 and sum(r["count"] for r in files) == 300_000
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        for r in files:
            tasks = spark.read.parquet(r["file"]).groupBy(F.spark_partition_id()).count().collect()
            assert max(t["count"] for t in tasks) < 0.8 * r["count"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
