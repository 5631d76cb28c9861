"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import release, scratch, stage


def components(edges: DataFrame) -> DataFrame:
    """node, label: each node that has an edge, with the least node it can reach. Edges are a, b.

    Alternates two steps until nothing changes: every node ties its larger neighbours to its least
    one, then its smaller neighbours and itself. Paths shrink by half each time and the number of edges
    does not grow. Neighbours of a node are never gathered; a node's minimum is a sum of partial
    ones, and each round is written in place of the one before, so that no lineage builds up.
    """
    spark = edges.sparkSession
    work = scratch(spark, "components")

    def signature(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        f"{work}/0",
    )
    before, turn = signature(e), 0
    while True:
        turn += 1
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        # Every edge is the larger neighbour of one of its ends, which is its v in `e`.
        large = e.join(least.withColumnRenamed("u", "v"), "v").select("u", F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("x"))
        e = stage(small.select("x.u", F.col("x.m").alias("v")).where("u <> v").distinct(), f"{work}/{turn}")
        now = signature(e)
        release(spark, f"{work}/{turn - 1}")
        if now == before:
            break
        before = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(roots)
