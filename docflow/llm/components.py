"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import staged


def _followed(step: DataFrame) -> DataFrame:
    """Pointers ``node, to`` to the last node on the way; each points down or to itself."""
    while True:
        beyond = step.select(F.col("node").alias("to"), F.col("to").alias("next"))
        moved = staged(step.join(beyond, "to").select("node", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")), "pointers")
        step = moved.select("node", "to")
        if moved.where("moved").isEmpty():
            return step


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a, b``): the smallest node reachable.

    Each round lets every node point to its smallest neighbour, follows these pointers
    to their ends by doubling, and contracts the links accordingly, until none is left.
    At most half of the nodes of a component are ends, so rounds and doublings grow with
    the logarithm of the number of nodes. Minima are aggregated before they are shuffled, so a node with
    very many links is no hot key there; in the joins adaptive execution splits it.
    Nulls and links of a node to itself are left out; no links give no rows.
    """
    ordered = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = staged(ordered.distinct(), "links")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        step = _followed(staged(smallest.select("node", F.least("node", "near").alias("to")), "pointers"))
        if labels is None:
            labels = step.select("node", F.col("to").alias("component"))
        else:
            moved = step.select(F.col("node").alias("component"), "to")
            labels = labels.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
            labels = staged(labels, "labels")
        for end in ("a", "b"):
            edges = edges.join(step.select(F.col("node").alias(end), "to"), end).drop(end).withColumnRenamed("to", end)
        ordered = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        edges = staged(ordered.distinct(), "links")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
