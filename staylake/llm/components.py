"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.llm.common import cut


def _state(e: DataFrame):
    """Row count and order-free content sum of a link table (one row)."""
    h = F.xxhash64("hi", "lo").cast("decimal(38,0)")
    return e.agg(F.count("*").alias("n"), F.sum(h).alias("h")).first()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root``: every node of ``links`` with the smallest node it reaches.

    ``links`` has two long columns; direction, repeats and self-links do not
    matter, null ends are ignored. Each round points the neighbours of every
    node at its smallest neighbour (first those above it, then those below),
    as joins on the node; the number of rounds grows with the logarithm of
    the longest path. The links stay distributed, and each round is
    checkpointed, so a lost executor costs one round. An empty table gives an
    empty result.
    """
    e = links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    e = cut(e.where("hi <> lo").distinct())
    state = _state(e)
    while state.n:
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            e.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(low, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        e = cut(moved.unionByName(low.select("hi", F.col("m").alias("lo"))).distinct())
        before, state = state, _state(e)
        if before == state:
            break
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )
