"""Connected components of an edge list, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import staged


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1] or 0


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (the smallest node in reach) for every node of `links`
    that is not its component's smallest.

    Each round hangs every node's larger neighbours under the smallest node
    next to it, then does the same with the smaller ones; the number of rounds
    grows with the logarithm of the longest path. Every round's edges are
    written, so lineage stays short; nothing but two numbers is collected."""
    edges = staged(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct(), "links"
    )
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(staged(low, "lows"), "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(staged(low, "lows"), "u")
        edges = staged(
            small.select(F.col("u"), F.col("m").alias("v"))
            .unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
            .distinct(),
            "small-star",
        )
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
