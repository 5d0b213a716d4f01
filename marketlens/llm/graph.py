"""Connected components by smallest label, in rounds that contract the edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` (smallest node of its component) from edges ``a``, ``b``.

    In a round every node points to its smallest neighbour, if that is smaller; pointers are followed to
    their ends by doubling, so a chain is halved per step. Then edges are drawn between the ends only, and
    those inside one end's nodes are gone: a large group is one node after its first round, and its edges are
    read once. Every round leaves at most half the nodes. Smallest neighbours are combined in each task
    before the shuffle.
    """
    rounds = []
    edges = cut_lineage(edges.select("a", "b").distinct())
    while True:
        rounds.append(_ends(edges))
        ends = rounds[-1]
        left = edges.join(ends.select(F.col("node").alias("a"), F.col("label").alias("la")), "a")
        left = left.join(ends.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b").filter("la <> lb")
        edges = cut_lineage(left.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct())
        if not edges.limit(1).count():
            break
    labels = rounds.pop()
    while rounds:
        # An end that met no other component is in no later round.
        later = labels.select(F.col("node").alias("_end"), F.col("label").alias("_last"))
        own = rounds.pop()
        joined = own.join(later, own["label"] == later["_end"], "left")
        labels = cut_lineage(joined.select("node", F.coalesce("_last", "label").alias("label")))
    return labels


def _ends(edges: DataFrame) -> DataFrame:
    """``node``, ``label``: where the way from a node over smallest neighbours ends."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    to = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        # The way has one step more where the next node is not its own label.
        up = to.filter("label <> node").select(F.col("node").alias("_next"), F.col("label").alias("_up"))
        moved = cut_lineage(to.join(up, to["label"] == up["_next"], "left").select("node", F.coalesce("_up", "label").alias("label"), F.col("_up").isNotNull().alias("_on")))
        to = moved.select("node", "label")
        if not moved.filter("_on").limit(1).count():
            return to
