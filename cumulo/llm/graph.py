"""Connected components by alternating star operations, as DataFrame joins.

Every round hangs each node's larger neighbours on its smallest neighbour (large star), then each
node and its smaller neighbours on the smallest of them (small star). The smallest neighbour is an
aggregate joined back on the node, never a window over one node's neighbours, so the join of a hub
can be split. Each round is written to the shared folder; it ends when a round changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of ``edges(u, v)``; component is the smallest node reachable."""
    edges = edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = materialize(edges, "links")
    before = _state(edges)
    while before[0]:
        # large star
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = edges.groupBy("u").agg(F.min("v").alias("m")).unionByName(edges.groupBy("v").agg(F.min("v").alias("m")).withColumnRenamed("v", "u"))
        least = least.groupBy("u").agg(F.min("m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star
        large = materialize(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
