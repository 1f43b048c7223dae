"""Connected components as rounds of DataFrame joins; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thicket.llm.runtime import materialise, release


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges(a, b); component is the least node reachable.

    Alternates two steps until no edge changes: every node hooks its larger
    neighbours to its least neighbour, then every node hooks its smaller
    neighbours to it.  The number of rounds is logarithmic in the longest path
    and each round writes its edges to the shared folder, so a lost executor
    costs one round at most.  Joins are merge joins: their sides grow with the
    edges, and a broadcast would pass through the driver.  Null nodes and loops
    are ignored; an empty input gives an empty result.
    """
    pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct()
    pairs = materialise(pairs, "edges")
    before = None
    for _ in range(max_rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        last, pairs = pairs, materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        release(last)
        row = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if row == before:
            break
        before = row
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = pairs.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
