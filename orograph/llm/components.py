"""Connected components of a graph held in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialised


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges(a, b): root is the smallest node of its component.

    Large-star and small-star steps in turn: in each, a node's neighbours are hung on its smallest neighbour. Only the minimum of a node's
    neighbours is gathered (partial sums on the map side, a join that adaptive execution may split), never its list. Rounds grow with the
    logarithm of the components' size; each ends in the shared folder. Null ends and loops are left out; no edges: no rows."""
    now = materialised(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        # large star: the larger neighbours of u, on the smallest of u and its neighbours
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # kept apart from the join, so that the rows of a hub can be split
        least = materialised(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        now = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours, on the smallest of them
        least = now.groupBy("u").agg(F.min("v").alias("m"))
        joined = now.join(least, "u")
        now = materialised(joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    return now.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root")))
