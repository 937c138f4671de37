"""Connected components of an edge table by alternating star contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = both.filter("v > u").join(least, "u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).filter("u != v")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v), both long; root is the least node.

    Each round contracts stars and cuts lineage in the shared folder; the edges never grow in
    number. Rounds follow the logarithm of the longest path. Loops, repeated edges and an
    empty table are fine; edges with a null end are no edges.
    """
    now = cut(edges.dropna().filter("u != v").distinct())
    seen = None
    while True:
        now = cut(_small_star(_large_star(now)).distinct())
        state = now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == seen:
            break
        seen = state
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )
