"""Connected components of a link table by minimum labels and pointer jumping, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farpoint.llm.scratch import Scratch


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); label = smallest node reachable.

    Each round takes the least label of the neighbours, then jumps to the
    label's own label; rounds are written to the shared folder, so lineage
    stays short.  Ends when no label changes.  No links give no rows.
    """
    both = scratch.save(links.select(F.col("a").alias("u"), F.col("b").alias("v"))
                        .unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
                        .distinct())
    labels = scratch.save(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
                          .select("node", F.least("node", "m").alias("label")))
    while True:
        near = (both.join(labels, F.col("v") == F.col("node")).groupBy("u")
                .agg(F.min("label").alias("m")))
        step = scratch.save(labels.join(near, F.col("node") == F.col("u")).select(
            "node", F.least("label", "m").alias("label"), F.col("label").alias("old")))
        up = step.select(F.col("node").alias("p"), F.col("label").alias("up"))
        jumped = scratch.save(step.join(up, F.col("label") == F.col("p")).select(
            "node", F.col("up").alias("label"), (F.col("up") != F.col("old")).alias("changed")))
        moved = jumped.filter("changed").limit(1).count()
        scratch.drop(labels, step)
        labels = jumped
        if not moved:
            scratch.drop(both)
            return labels.select("node", "label")
