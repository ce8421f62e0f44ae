"""Connected components by alternating large-star and small-star joins (DataFrame only).

Every round rewrites the edge list with two aggregations and two joins and
stores it in the shared folder, so lineage stays short and a lost executor
costs one round. The minimum of a node's neighbours is a partial aggregation,
and a hub's edges are a skewed join side that AQE splits; nothing is gathered
to the driver but a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


def _summary(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edges.select("v", "u"))
    least = both.groupBy("x").agg(F.min("y").alias("least"))
    return (both.join(least, "x").filter("y > x")
            .select(F.col("y").alias("u"), F.least("x", "least").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    joined = edges.join(least, "u")
    return joined.filter("v > least").select(F.col("v").alias("u"), F.col("least").alias("v")).union(least.select("u", "least")).distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node of an edge; component is the least node.

    Edges with a null end and loops are ignored; no edges give no rows. Rounds
    go on until the edge list is a set of stars and no longer changes.
    """
    a, b = F.col(src), F.col(dst)
    now = stored(edges.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    seen = _summary(now)
    while seen[0]:
        now = stored(_small_star(_large_star(now)), "edges")
        if (summary := _summary(now)) == seen:
            break
        seen = summary
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
