"""Connected components of a table of links, in alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.sources.storage import materialize


def _to_smallest(edges: DataFrame, upward_only: bool) -> DataFrame:
    """Point the neighbours of each node to the smallest node in sight.

    `edges` has rows (u, v). With `upward_only` (large star) the neighbours above u move,
    else (small star, v < u) all neighbours and u itself. The smallest is a map-side
    minimum; the join back is one row for each u against its edges, which Spark splits
    where a hub has very many.
    """
    lows = edges.groupBy("u").agg(F.min("v").alias("low"))
    joined = edges.join(lows, "u")
    low = F.least("low", "u")
    if upward_only:
        return joined.where("v > u").select(F.col("v").alias("hi"), low.alias("lo"))
    moved = joined.where("v <> low").select(F.col("v").alias("hi"), F.col("low").alias("lo"))
    return moved.unionByName(lows.select(F.col("u").alias("hi"), F.col("low").alias("lo")))


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of `links` (a, b) but the smallest of each component.

    The label is the smallest node of the component. Links may repeat and may lead from a
    node to itself. Every round is written to the shared folder, and what the driver sees of
    it is one count and one checksum; rounds grow with the logarithm of the nodes.
    """
    hi, lo = F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    edges = materialize(links.where("a <> b").select(hi, lo).distinct(), "links")
    seen = None
    while True:
        state = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")
        ).first()
        if state == seen or not state["n"]:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("label"))
        seen = state
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        large = _to_smallest(both, upward_only=True).distinct()
        down = large.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        edges = materialize(_to_smallest(down, upward_only=False).distinct(), "links")
