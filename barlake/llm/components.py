"""Connected components of an edge table, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import staged


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b of type long); the
    component is its smallest node.

    Alternates two contractions until nothing changes: every node links its larger
    neighbours to the smallest of its neighbourhood, then its smaller neighbours and itself
    to the smallest of them. Rounds grow with the logarithm of the graph's size. A hub is a
    partial minimum in the aggregation and a splittable side in the join. Each round is a
    written table; the driver sees a row count and a checksum of it. Loops, repeated edges
    and edges with a null end are ignored; no edges give no rows.
    """
    ends = edges.filter(F.col("a") != F.col("b"))
    current = staged(
        ends.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), label
    )
    seen = _state(current)
    while True:
        current = staged(_contract(current), label)
        now = _state(current)
        if now == seen:
            break
        seen = now
    members = current.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    roots = current.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return members.unionByName(roots)


def _contract(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    large = (
        both.filter(F.col("v") > F.col("u"))
        .join(least, "u")
        .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        .distinct()
    )
    least = large.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = large.join(least, "hi").filter(F.col("lo") != F.col("m"))
    return (
        moved.select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        .unionByName(least.select("hi", F.col("m").alias("lo")))
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())
