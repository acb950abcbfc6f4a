"""Connected components of a link table by alternating large-star and small-star rounds.

Each round is two joins on a node key whose large keys Spark may split, after per-node
minima that are combined ahead of the shuffle.  Rounds are written to the shared folder, so
a lost executor costs one round; only a count and a checksum come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddockflow import scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over (a, b) rows with a > b."""
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    seen = edges.unionByName(turned) if large else edges
    least = seen.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    met = (turned if large else edges).join(least, "a")
    moved = met.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not large:
        moved = moved.unionByName(least.select("a", F.col("least").alias("b")))
    else:
        # links to smaller neighbours stay for the small-star step
        moved = moved.unionByName(least.filter("least < a").select("a", F.col("least").alias("b")))
    return moved.filter("a > b").distinct()


def labels(links: DataFrame) -> DataFrame:
    """(node, label) for every node with a link; label is the smallest node of its component.

    ``links``: columns a and b of one orderable type; direction, repeats and self links do
    not matter.  No link gives no rows.
    """
    edges = scratch.saved(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(),
        "links",
    )
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            break
        before, last = state, edges
        edges = scratch.saved(_star(_star(last, True), False), "links")
        scratch.remove_saved(last)
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
