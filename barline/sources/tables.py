"""Table scan (S01) and table sink (S02) for Parquet, JDBC or any Spark format."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession


def read_table(spark: SparkSession, source: str, format: str = "parquet",  # noqa: A002
               options: Mapping[str, str] | None = None,
               columns: Sequence[str] | None = None,
               where: str | Column | None = None,
               partition_column: str | None = None, lower_bound: int | None = None,
               upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Scan a table.

    ``source`` is a path for file formats and a table name for ``jdbc`` (with
    ``url``/``user``/``password``/``driver`` in ``options``). ``columns`` and
    ``where`` are applied to the lazy relation, so Catalyst pushes them into
    the scan (Parquet ``ReadSchema``/``PushedFilters``, a JDBC ``WHERE``). For
    JDBC, ``partition_column`` with bounds splits the read into
    ``num_partitions`` parallel range queries instead of one connection.
    """
    reader = spark.read.format(format).options(**dict(options or {}))
    if format == "jdbc":
        reader = reader.option("dbtable", source)
        if partition_column:
            reader = (reader.option("partitionColumn", partition_column)
                      .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                      .option("numPartitions", str(num_partitions or 8)))
        df = reader.load()
    else:
        df = reader.load(source)
    if where is not None:
        df = df.filter(where)
    if columns:
        df = df.select(*columns)
    return df


def by_partition(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` shuffled by its partition columns, so that the files of a partition
    do not grow with the number of tasks that made its rows; AQE splits a large
    partition over several tasks and puts small ones together."""
    return df.hint("rebalance", *columns)


def write_table(df: DataFrame, target: str, format: str = "parquet",  # noqa: A002
                mode: str = "append", options: Mapping[str, str] | None = None,
                partition_by: Sequence[str] | None = None) -> None:
    """Write ``df`` with any save mode (default ``append``, as the reference).

    With ``mode="overwrite"`` and ``partition_by`` only the partitions present
    in ``df`` are replaced (dynamic partition overwrite, set on the write), which
    makes a re-run of one day's job idempotent. For ``jdbc`` the target
    is the table name.
    """
    if partition_by:
        df = by_partition(df, partition_by)
    w = df.write.format(format).mode(mode).options(**dict(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
        if mode == "overwrite":   # replace only the partitions present in df
            w = w.option("partitionOverwriteMode", "dynamic")
    if format == "jdbc":
        w.option("dbtable", target).save()
    else:
        w.save(target)
