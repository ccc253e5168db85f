"""Connected components of a distributed edge list by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every end of ``edges`` (columns ``a``, ``b``); root is the least node reachable.

    Each step links the neighbours of a node to the least of them (large star:
    the greater neighbours; small star: the lesser ones) until nothing moves.
    Every step is a grouped aggregate and a join, written as a table.
    """
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    now = stored(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        sides = both(now)
        least = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = sides.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        large = stored(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        now = stored(small, "edges")
        seen = now.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
