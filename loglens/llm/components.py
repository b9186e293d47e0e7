"""Connected components of an edge table, by alternating star contractions.

Large-star links every larger neighbour of a node to its smallest neighbour,
small-star every smaller one; both keep connectivity, and repeated they leave
one star per component around its smallest node. Each round is two
pre-aggregated groupings and joins on nodes (AQE splits hot ones) and is
written to the shared folder, which cuts the lineage and survives lost
executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm.store import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("m"))
    return (both.where("dst > src").join(least, "src")
            .select(F.col("dst").alias("src"), F.col("m").alias("dst")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    # Edges run from the larger to the smaller node.
    least = edges.groupBy("src").agg(F.min("dst").alias("m"))
    moved = edges.join(least, "src").where("dst <> m").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    return least.select("src", F.col("m").alias("dst")).unionByName(moved).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (src, dst; loops and repeats allowed) -> (node, component) for every
    node with an edge to another one; ``component`` is the smallest node reachable."""
    now = stored(edges.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "edges")
    mark = None
    while True:
        row = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("src", "dst")).alias("x"),
                      F.sum(F.xxhash64("dst", "src").cast("decimal(38,0)")).alias("s")).first()
        if row["n"] == 0 or tuple(row) == mark:
            return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(
                now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct())
        mark = tuple(row)
        now = stored(_small_star(_large_star(now)), "edges")
