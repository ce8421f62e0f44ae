"""Session construction and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (candle buckets are UTC) and
# adaptive execution so shuffle partition counts follow the real data size.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster (used when no master is given): start with many
# shuffle partitions and let AQE coalesce them to ~256 MB each, split scans
# at 256 MB, and let AQE split skewed join partitions and partial-aggregate
# before every shuffle.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "barline", extra: dict | None = None) -> SparkSession:
    """Get or create a session with the library's base settings.

    On a cluster pass ``master=None`` and let spark-submit decide: the settings
    of CLUSTER_CONF then hold, unless given otherwise. AQE coalesces small
    shuffle partitions and splits skewed join sides (not aggregations or
    windows). With a master, 8 shuffle partitions are the default.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if not master:
        conf.update(CLUSTER_CONF)
    if master or shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must exist (a machine-local folder would vanish
    with its executor). Only a local session without the setting, as in
    tests, gets a fresh folder of its own, which is then written back into
    the session so every later caller sees the same one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="barline-ckpt-")
    spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage where several branches of one plan read the same input
    (the EMA block-end branch, the fact join): they re-scan a small stored
    table instead of re-running the aggregation that produced it. A reliable
    write, not ``localCheckpoint``, so a lost executor loses nothing.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    out = spark.read.parquet(path)
    out._stored_at = path
    return out


def discard(df) -> None:
    """Delete the folder of a :func:`stored` table that nothing will read again
    (an earlier round, a run's scratch); other tables are left alone."""
    at = getattr(df, "_stored_at", None)
    if at:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
