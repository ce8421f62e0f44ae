from pyspark.sql import functions as F

from barline.session import checkpoint_root, stored, work_path
from barline.sources.candle_views import raw_e, raw_l
from barline.sources.tables import read_table, write_table

SF = "/root/testdata/sf0.001"


def test_checkpoint_root_reads_session_setting(spark):
    root = checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert work_path(spark, "x").startswith(root + "/x-")


def test_read_table_prunes_columns_and_pushes_filters(spark):
    df = read_table(spark, f"{SF}/lineitem.parquet", columns=["l_orderkey", "l_quantity"],
                    where=F.col("l_quantity") > 10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_write_table_overwrite_is_idempotent(spark):
    path = work_path(spark, "t-write")
    df = raw_e(spark, SF).withColumn("d", F.to_date("ingested_at"))
    write_table(df, path, mode="overwrite", partition_by=["d"])
    write_table(df.filter("d = DATE'2024-01-01'"), path, mode="overwrite", partition_by=["d"])
    back = read_table(spark, path)
    assert back.count() == df.count()          # only that day's partition was replaced
    write_table(df, path, mode="append", partition_by=["d"])
    assert read_table(spark, path).count() == 2 * df.count()


def test_stored_round_trip(spark):
    df = raw_l(spark, SF)
    s = stored(df, "t-stored")
    assert s.count() == df.count() and s.columns == df.columns


def test_files_of_a_partition_do_not_grow_with_tasks(spark):
    df = raw_e(spark, SF).withColumn("d", F.to_date("ingested_at"))
    for tasks in (2, 24):
        path = work_path(spark, "t-files")
        write_table(df.repartition(tasks), path, partition_by=["d"])
        files = spark.read.parquet(path).select("d", F.input_file_name().alias("f")).distinct()
        assert files.count() == df.select("d").distinct().count()
