"""Connected components of an edge list, by joins alone.

Each round hooks every node to the smallest label around it (large star, then small star): the
components of any graph become stars after about log(nodes) rounds, and the rounds end when they are.  Hubs are
never gathered: a node's neighbours meet in a partial aggregate, and the join back is on the node, which Spark
splits when it is skewed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    other = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return other.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _all_stars(e: DataFrame) -> bool:
    """Every node has an edge to one smaller node at most, and a node that has one is no other's centre: a
    further round would change nothing."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 and up > 0").isEmpty()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, label`` of every node that has an edge to another; the label is the smallest node
    of its component.  Loops, repeated edges, nulls and empty inputs are fine (rows with a null
    end are no edges)."""
    e = written(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                .distinct(), "edges")
    while not _all_stars(e):
        e = written(_small_star(_large_star(e)), "edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
