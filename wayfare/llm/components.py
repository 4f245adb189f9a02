"""Connected components by alternating large-star and small-star steps.

Every step takes the smallest neighbour of each node, an aggregate that is combined before it is
exchanged, and joins it back. Both sides of that join are written first, so that adaptive
execution can split a node with very many neighbours. The links shrink to one star per
component in a number of steps that grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.session import materialise, materialise_with

MAX_STEPS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step on edges (a, b) with a > b."""
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    seen = edges.unionByName(turned) if large else edges
    least = materialise(seen.groupBy("a").agg(F.min("b").alias("_b")))
    least = least.select("a", F.least("a", "_b").alias("m"))
    if large:
        # Larger neighbours of a node go to its smallest one.
        moved = turned.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = edges.join(least, "a").select(
            F.inline(
                F.array(
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                    F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                )
            )
        )
    return moved.filter("a > b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; root is the smallest node it can reach.

    `links` has columns a and b (long, no nulls); their order, repeats and links of a node
    with itself do not matter. No links give no rows.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    total = {
        "n": F.count(F.lit(1)),
        "h": F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)),
    }
    edges, state = materialise_with(edges.filter("a > b").distinct(), **total)
    for _ in range(MAX_STEPS):
        if not state["n"]:
            break
        between = materialise(_star(edges, large=True))
        edges, found = materialise_with(_star(between, large=False), **total)
        if found == state:
            break
        state = found
    else:
        raise RuntimeError("the links did not settle")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
