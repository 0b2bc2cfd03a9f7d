"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halfstar.session import materialise


def _compressed(parent: DataFrame) -> DataFrame:
    """Follow ``parent`` (node, p), p <= node, up to the roots by pointer doubling."""
    while True:
        up = parent.select(F.col("node").alias("p"), F.col("p").alias("pp"))
        stepped = parent.join(up, "p").select(
            "node", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")
        )
        parent = materialise(stepped, "cc-jump")
        if parent.filter("moved").isEmpty():
            return parent.select("node", "p")


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)`` (longs); component = smallest node.

    Each round hangs every node below its smallest neighbour, follows these
    pointers to their roots, and replaces nodes by roots in the links. Every
    tree has two nodes at least, so a round halves the nodes that still have
    links; rounds grow with the logarithm of the nodes whatever the shape. All
    state is in written tables, nothing passes through the driver. Sums per
    node combine on the map side; joins at a hub are split by adaptive
    execution. Null ends and self-links are ignored; an empty table gives none.
    """
    links = materialise(
        links.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "cc-links",
    )
    labels = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min("b").alias("b"))
        parent = _compressed(materialise(nearest.select(F.col("a").alias("node"), F.least("a", "b").alias("p")), "cc-parent"))
        if labels is None:
            labels = parent
        else:
            up = parent.select(F.col("node").alias("p"), F.col("p").alias("pp"))
            labels = materialise(
                labels.join(up, "p", "left").select("node", F.coalesce("pp", "p").alias("p")), "cc-labels"
            )
        ends = [parent.select(F.col("node").alias(c), F.col("p").alias(f"p{c}")) for c in ("a", "b")]
        moved = links.join(ends[0], "a").join(ends[1], "b").filter("pa != pb")
        links = materialise(
            moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "cc-links"
        )
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels.select("node", F.col("p").alias("component"))
