"""Connected components of an undirected graph given by links (a, b)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomart.llm.stages import dropped, stored


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    Each round hangs every node onto the smallest one around it, follows the hangers to their ends by
    pointer jumping, and goes on with the links between the trees only, named by their roots. A root
    that hung nowhere has a neighbour that did, so two rounds at least halve the nodes that still have
    links, whatever the order of the ids and the diameter, and the loop ends by itself. Tables are
    written each round, which cuts the lineage and survives lost executors. A node with very many links
    has its neighbours reduced before the shuffle; towards the neighbours the links side is a plain
    exchange, which adaptive execution can split.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both, labels = stored(both, "both"), None
    while labels is None or not both.isEmpty():
        roots = _roots(both)
        if labels is None:
            labels, named = roots, None
        else:
            parent = roots.select(F.col("node").alias("component"), F.col("component").alias("root"))
            named = labels.join(parent, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
            before, labels = labels, stored(named, "labels")
            dropped(before)
        left = roots.select(F.col("node").alias("a"), F.col("component").alias("x"))
        right = roots.select(F.col("node").alias("b"), F.col("component").alias("y"))
        rest = both.join(left, "a").where("x <> b").join(right, "b").where("x <> y")
        before, both = both, stored(rest.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "both")
        dropped(before)
        if named is not None:
            dropped(roots)
    dropped(both)
    return labels


def _roots(both: DataFrame) -> DataFrame:
    """(node, component): the end of the way from each node over the smallest neighbour at a time."""
    roots = stored(
        both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component")), "roots")
    while True:
        jump = roots.select(F.col("node").alias("component"), F.col("component").alias("far"))
        if roots.join(jump, "component").where("far <> component").isEmpty():
            return roots
        before, roots = roots, stored(roots.join(jump, "component").select("node", F.col("far").alias("component")), "roots")
        dropped(before)
