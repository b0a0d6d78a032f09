"""Connected components of a graph given by its edges, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.scratch import saved


def _with_least(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the smallest of u and its neighbours."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return edges.join(least, "u")


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; root is the component's least node.

    ``edges`` has long columns u and v, in either direction, repeats allowed. Rounds of
    large and small stars hang every node on its least neighbour until nothing changes;
    each keeps at most as many edges as the one before. No group is gathered: a hub's
    minimum is pre-aggregated, and its edges meet it in a join that Spark may split.
    """
    clean = edges.where(F.col("u") != F.col("v")).select("u", "v")
    down = clean.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current = saved(down, "edges")
    known = _signature(current)
    while True:
        both = current.union(current.select("v", "u"))
        large = (
            _with_least(both)
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        met = _with_least(large)
        small = met.select(F.col("v").alias("u"), F.col("m").alias("v")).union(met.select("u", "m"))
        current = saved(small.where(F.col("u") != F.col("v")).distinct(), "edges")
        now = _signature(current)
        if now == known:
            break
        known = now
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(current.select(F.col("v"), F.col("v"))).distinct()
