"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypeline.llm.common import discard, materialise


def _to_smallest(edges: DataFrame, larger: bool) -> DataFrame:
    """One contraction.  ``larger``: every node links its larger neighbours to the
    smallest node it sees; otherwise it links its smaller neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if larger:
        near = both
        pick = F.col("v") > F.col("u")
    else:
        near = both.where("v < u")
        pick = F.lit(True)
    low = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    met = near.join(low, "u")
    out = met.where(pick).select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not larger:
        out = out.unionByName(low.select("u", F.col("m").alias("v")))
    return out.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link; root is the smallest node of its
    component.  Each round is written to shared storage, so the plan stays short
    and lost executors cost one round.  Rounds grow with the logarithm of a
    component's size; the smallest neighbour is found by a combining aggregate,
    so a node with a very large number of links is no single task's work."""
    edges = materialise(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                        .where("u != v").distinct(), "links")
    seen = None
    while True:
        row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))).alias("h")).first()
        if row["n"] == 0 or (row["n"], row["h"]) == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = (row["n"], row["h"])
        after = materialise(_to_smallest(_to_smallest(edges, True), False), "links")
        discard(edges)
        edges = after


__all__ = ["components"]
