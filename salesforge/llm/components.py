"""Connected components of an undirected graph, by alternating large-star and small-star steps.

Each step is a minimum per node (combined before the shuffle) and a join back to the edges, so no neighbourhood and no
component is ever gathered in one place.  Every round is cut with a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Links every larger (else: smaller or equal) neighbour of u, and u, to u's smallest neighbour or itself."""
    least = pairs.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.min("u")).alias("m"))
    linked = pairs.join(least, F.col("u") == F.col("w"))
    if large:
        out = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns u, v); the root is the component's smallest node."""
    edges = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .distinct())
    state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while True:
        after_large = _star(_both_ways(edges), large=True)
        edges = materialize(_star(after_large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")),
                                  large=False))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
