"""Connected components of an edge table, by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` with the smallest reachable node as label, for the nodes of ``edges(a, b)``.

    Each round takes the least label among a node's neighbours and follows it one step,
    so chains shorten by half. Rounds end when no label changes; each is written to the
    shared folder, so a lost executor costs one round at most.
    """
    both = edges.select("a", "b").filter("a <> b")
    both = cut_lineage(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        nearest = (
            both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a")).agg(F.min("label").alias("near"))
        )
        taken = labels.join(nearest, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("before"), F.least("label", "near").alias("label")
        )
        parents = labels.select(F.col("node").alias("label"), F.col("label").alias("parent"))
        stepped = taken.join(parents, "label").select("node", "before", F.least("label", "parent").alias("label"))
        new = cut_lineage(stepped, "labels")
        labels = new.select("node", "label")
        moved = not new.filter("label <> before").isEmpty()
        if not moved:
            return labels
