"""Connected components of an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.session import cut_lineage

def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, comp): ``comp`` is the lowest node of the component. ``edges`` has columns a and b, in any direction.

    Each round takes the lowest label among the neighbours and then follows that label's own label, so chains shorten
    by half; rounds are checkpointed and end when no label falls, as labels only ever fall.
    """
    both = cut_lineage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = cut_lineage(nodes.select("node", F.col("node").alias("comp")))
    while True:
        heard = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("comp").alias("heard"))
        )
        lowered = labels.join(heard, "node", "left").select(
            "node", "comp", F.least("comp", "heard").alias("next")
        )
        roots = labels.select(F.col("node").alias("next"), F.col("comp").alias("root"))
        jumped = cut_lineage(
            lowered.join(roots, "next", "left").select("node", "comp", F.least("next", "root").alias("next"))
        )
        changed = jumped.where(F.col("next") < F.col("comp")).limit(1).count()
        labels = jumped.select("node", F.col("next").alias("comp"))
        if not changed:
            return labels
