"""Connected components of an edge table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, small

#: A node of more edges than this is a hub: its label is sent to its edges instead of its edges to its label.
HUB_EDGES = 10_000


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, comp) for every node of the edges (a, b): comp is the smallest node that it is connected to.

    Each round takes the smallest label among neighbours and then the label of that label, so long chains
    shrink by half a round or more. Labels are written between rounds; nothing reaches the driver but counts.
    Edges of hubs, and labels that many nodes have, meet small tables in broadcast joins, so no task gets all of one.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = scratch.table(both, "edges")
    hubs = scratch.table(both.groupBy("b").agg(F.count("*").alias("n")).where(F.col("n") > HUB_EDGES).select("b"), "hubs")
    some = hubs.limit(1).count() > 0
    labels = scratch.table(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("comp")), "labels")
    while True:
        named = labels.select(F.col("node").alias("b"), "comp")
        if some:
            held = small(named.join(small(hubs), "b", "left_semi"))
            met = both.join(small(hubs), "b", "left_anti").join(named, "b").unionByName(both.join(held, "b"))
        else:
            met = both.join(named, "b")
        near = met.groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("m"))
        stepped = labels.join(near, "node").select("node", F.least("comp", "m").alias("comp"), F.col("comp").alias("old"))
        stepped = scratch.table(stepped, "step")
        # Labels that have a smaller label themselves.
        used = stepped.select("comp").distinct()
        jump = scratch.table(stepped.where("comp < node").select(F.col("node").alias("comp"), F.col("comp").alias("up")).join(used, "comp", "left_semi"), "jump")
        moved = scratch.table(stepped.join(small(jump), "comp", "left").select("node", F.least("comp", F.coalesce("up", "comp")).alias("comp"), "old"), "labels")
        changed = moved.where("comp <> old").limit(1).count()
        scratch.drop(labels, stepped, jump)
        labels = moved.drop("old")
        labels._scratch_path = moved._scratch_path
        if not changed:
            scratch.drop(both, hubs)
            return labels
