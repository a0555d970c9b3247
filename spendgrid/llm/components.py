"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum and a join on the node; each round is written
to the shared folder, so lineage stays short. Edges converge to one star per
component, with its least node in the middle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgrid.llm.common import Scratch


def _star(pairs: DataFrame) -> DataFrame:
    """``u, v, m``: the pairs with the least of ``u`` and its partners."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("u_"), F.least("m", "u_").alias("m"))
    return pairs.join(least, pairs["u"] == least["u_"]).select("u", "v", "m")


def connected_components(links: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of ``links`` but the roots themselves,
    which are the least nodes of their components. Links to itself, repeated
    links and links with a null end do not matter."""
    edges = scratch.write(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(f"{a} is not null and {b} is not null and u > v").distinct(), "links")
    state = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        small = _star(large)
        after = scratch.write(small.select("u", F.col("m").alias("v")).union(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))).where("u > v").distinct(), "stars")
        scratch.drop(edges)
        edges = after
        now = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return after.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
