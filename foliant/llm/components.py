"""Connected components by alternating large-star and small-star steps, entirely in DataFrames.

Every step is written to the shared folder, so lineage stays short and a lost executor costs one step. Joins read
two written tables, which lets adaptive execution split a node that has very many neighbours.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import drop_written, written


def _lowest(pairs: DataFrame) -> DataFrame:
    """Of (u, v): the least v of each u, where it is below u."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).where("m < u")


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first())


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) for every node of an edge, root being the least node reachable from it. Self-loops and null
    ends are ignored; repeated edges count once. No edges: no rows."""
    known = edges.where(F.col(u) != F.col(v))  # no null end either
    now = written(known.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "edges")
    before = _signature(now)
    while before[0]:
        # large star: each neighbour above u is linked to the least of u and its neighbours
        low = written(_lowest(now.union(now.select("v", "u"))), "low")
        above = now.select(F.col("v").alias("u"), F.col("u").alias("v"))
        up = above.join(low, "u", "left").select(F.col("v").alias("u"), F.coalesce("m", "u").alias("v"))
        star = written(up.where("u <> v").distinct(), "large")
        # small star: u and each neighbour below it are linked to the least of those
        low2 = written(_lowest(star), "low")
        down = star.join(low2, "u")
        small = down.select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v")))
        after = written(small.where("u <> v").distinct(), "small")
        signature = _signature(after)
        for old in (now, low, star, low2):
            drop_written(old)
        now = after
        if signature == before:
            break
        before = signature
    root = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return root.union(root.select("root", "root").distinct())
