"""Connected components of an edge table, by written rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``(id, comp)`` for all ids in ``edges`` ``(a, b)`` of longs; ``comp`` is the smallest id of the component.

    Each round moves every edge to the smallest neighbour of its ends: an id
    hands its neighbours that are larger to its smallest neighbour, then each
    keeps one link to its own smallest. A component becomes a star in about
    log n rounds. Both halves are partial minima and joins that Spark may split,
    so a hub is never gathered.
    """
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    before = None
    for _ in range(MAX_ROUNDS):
        # Large star: larger neighbours of u go to the smallest of u and its neighbours.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: smaller neighbours and u itself go to the smallest.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = stage(small.select("e.u", "e.v").where("u <> v").distinct(), "cc")
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(roots)
