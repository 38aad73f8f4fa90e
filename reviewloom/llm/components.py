"""Connected components by alternating stars.

Every round hangs the larger neighbours of a node, then its smaller ones, below their least member;
the number of rounds grows with the logarithm of the graph's size. A node with very many neighbours
is one hash-aggregation key with map-side combine and a join key that adaptive skew joins split: the
least members are stored first, because a join that reads an aggregation's partitions is never split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (least node reachable) for the nodes of ``edges(u, v)``. Loops are ignored."""
    edges = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    while (now := _state(edges)) != state:
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = stored(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        hung = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()
