"""Connected components of an edge table, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargauge.session import materialize


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an edge table; ``root`` is the smallest node reachable.

    Alternates large-star and small-star steps: each node hands its neighbours the smallest node it
    knows, until all edges point at roots. A step is two aggregations by node; a node's neighbours
    are never gathered in one place, and each step's edges are written to the shared folder, so that
    lost executors cost a retry only. The number of steps follows the logarithm of the component size.
    """
    pairs = (
        edges.select(F.col(left).alias("u"), F.col(right).alias("v"))
        .where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    pairs = materialize(pairs, "component-edges")
    before = _signature(pairs)
    while True:
        large = _star(pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))), larger_only=True)
        pairs = materialize(_star(large, larger_only=False), "component-edges")
        after = _signature(pairs)
        if after == before:
            break
        before = after
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _signature(pairs: DataFrame) -> tuple:
    """Number and hash sum of the (distinct) pairs: equal for equal sets, whatever their order."""
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38, 0)"))
    return tuple(pairs.agg(F.count(F.lit(1)), total).first())


def _star(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Point the neighbours of each ``u`` (for small-star also ``u``) at the smallest of them all."""
    smallest = pairs.groupBy("u").agg(F.min("v").alias("m"))
    smallest = smallest.select("u", F.least("u", "m").alias("m"))
    met = pairs.join(smallest, "u")
    if larger_only:
        moved = met.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = met.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(smallest.select("u", F.col("m").alias("v")))
    return moved.where(F.col("u") != F.col("v")).distinct()
