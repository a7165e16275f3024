"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.frames import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node in ``links``; component is the least node reachable.

    Each round points all larger neighbours of a node to its least neighbour (large star), then its other smaller
    ones (small star); the table of links never grows, and rounds grow with the logarithm of the longest
    path.  A hot node's least neighbour is a partial aggregate, and the join on it can be split by
    Spark, so no node's links need to meet in one task.  Every round is written to the shared
    folder; the driver learns whether all links are stars by then, that is, no node has two least nodes
    or is one itself and has one."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = stage(edges, "links")
    while not _is_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        edges = stage(small, "links")
    # now every node but the least of its component has one link, to that least node
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether each node of the distinct links (u, v), u > v, has one link as u and none as v, or any number as v alone."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))).alias("e"))
    return ends.groupBy("e.node").agg(F.sum("e.up").alias("up"), F.count("*").alias("n")).filter("up > 1 or up = 1 and n > 1").isEmpty()
