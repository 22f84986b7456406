"""Connected components of an edge table, by alternating large and small
stars.  Each round is a few aggregations and joins on node keys, written to
the shared folder; the number of rounds grows with the logarithm of the
longest chain.  A node of many edges is aggregated before it is shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odflow.llm.common import stored


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every edge runs from a node of one edge to one that is no
    edge's larger end: the edges then name each node's root."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")).select("e.*")
    nodes = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.filter("up > 1 or (up = 1 and down = 1)").isEmpty()


def connected(edges: DataFrame) -> DataFrame:
    """Edges (u, v) to (node, root): the smallest node of each component, for
    every node but the roots.  Self loops and repeated edges do no harm."""
    edges = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct(), "cc")
    while not _is_forest_of_stars(edges):
        # large star: the larger neighbours of a node go to its smallest
        both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = edges.join(least, edges["v"] == least["c"]).select(F.col("u"), F.col("m").alias("v")).filter("u > v")
        # small star: a node and its smaller neighbours go to the smallest of these; the row of the smallest stands for the node
        large = large.withColumn("m", F.min("v").over(Window.partitionBy("u")))
        small = large.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()
        edges = stored(small, "cc")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
