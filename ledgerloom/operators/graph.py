"""Connected components of an undirected graph, by alternating large-star and small-star steps.

Every step is a grouped minimum (combined on the map side) and one equi join; nothing is collected but two numbers per
round. Each round's edges are written to the shared folder, so a lost executor costs a read, not a recomputation; the
round before is removed then.

The steps end by themselves: each moves edges to smaller ends only, so the edges' sum falls until every component is a
star around its smallest node, and a star stays as it is. The number of rounds grows with the logarithm of the number of
nodes, so there is no limit on it.

Defined results: NULL ends and self-loops are ignored; repeated edges count once; an empty edge table gives an empty
result; every node of an edge appears once, labelled with the smallest node of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerloom.runtime import cut, discard

BROADCAST_EDGES = 100_000  # with more, no step is broadcast, however small its files are


def _kept(e: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The edges, written, and their number and checksum, taken while they are written."""
    seen = Observation()
    out = cut(e.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")))
    return out, (seen.get["n"], seen.get["h"])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component."""
    e = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("_a"), F.col(b).alias("_b"))
        .filter(F.col("_a").isNotNull() & F.col("_b").isNotNull() & (F.col("u") != F.col("v")))
        .select("u", "v")
        .distinct()
    )
    e, state = _kept(e)
    while state[0]:
        safe = (lambda x: x.hint("merge")) if state[0] > BROADCAST_EDGES else (lambda x: x)
        # large star: each larger neighbour is linked to the smallest neighbour
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(safe(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        # small star: a node and its smaller neighbours are linked to the smallest of them
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        j = large.distinct().join(safe(small_least), "u")
        small = j.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(j.select("u", F.col("m").alias("v")))
        before, last = e, state
        e, state = _kept(small.filter("u != v").distinct())
        discard(before)
        if state == last:
            break
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
