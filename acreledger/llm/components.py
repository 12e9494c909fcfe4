"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreledger.session import cut_lineage


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def components(links: DataFrame) -> DataFrame:
    """``node, component``: the smallest node that each linked node reaches.

    ``links`` has columns ``u, v``.  Large-star and small-star steps (Kiveris and others, 2014) alternate until
    every node points at its component's smallest; there are about as many rounds as the logarithm of the
    longest path.  Neighbours are never gathered: a node's smallest neighbour is an aggregate that combines
    before the shuffle, and it is joined back to the links.  Each round is checkpointed.
    """
    pointers = cut_lineage(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(pointers)
    while True:
        both = pointers.union(pointers.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")).select("w", F.least("w", "m").alias("m"))
        large = both.filter("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        linked = large.join(least, F.col("u") == F.col("w")).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pointers = cut_lineage(linked.union(least.select("w", "m")).distinct())
        found = _state(pointers)
        if found == state:
            break
        state = found
    stars = pointers.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(pointers.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
