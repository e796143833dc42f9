"""Connected components of a graph that is a table of links.

Every node points at the smallest of its neighbours and itself, pointers are followed to
their end, and the graph is contracted to what they point at; each round at least halves the nodes that
still have links.  All tables stay in Spark, in the shared work folder between the steps, so a
lost executor costs a step and not the chain.  Hot nodes are reduced before the shuffle
where links are aggregated, and are split by adaptive execution where stored tables are joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _follow(pointers: DataFrame) -> DataFrame:
    """``node, root`` with every root pointing at itself."""
    while True:
        to = pointers.select(F.col("node").alias("__at"), F.col("root").alias("__next"))
        further = pointers.join(to, pointers["root"] == to["__at"]).select(
            "node", F.col("__next").alias("root"), (F.col("__next") != F.col("root")).alias("moved")
        )
        further = stored(further, "pointers")
        pointers = further.select("node", "root")
        if further.where("moved").isEmpty():
            return pointers


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b`` (any direction, repeats allowed).

    The root is one node of the component, the same for all of it; a table without links gives no rows.
    """
    ends = links.where(F.col("a") != F.col("b"))
    both = stored(ends.select("a", "b").unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = None
    while True:
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("root"))
        roots = _follow(stored(lowest, "pointers"))
        if labels is None:
            labels = roots
        else:
            newer = roots.select(F.col("node").alias("__at"), F.col("root").alias("__next"))
            labels = stored(
                labels.join(newer, labels["root"] == newer["__at"], "left").select(
                    "node", F.coalesce("__next", "root").alias("root")
                ),
                "labels",
            )
        of_a = roots.select(F.col("node").alias("a"), F.col("root").alias("__a"))
        of_b = roots.select(F.col("node").alias("b"), F.col("root").alias("__b"))
        left = both.join(of_a, "a").join(of_b, "b").where(F.col("__a") != F.col("__b"))
        both = stored(left.select(F.col("__a").alias("a"), F.col("__b").alias("b")).distinct(), "links")
        if both.isEmpty():
            return labels
