"""Connected components of a link table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import written


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); label is the smallest node of its component.

    Each round takes the smallest label next to a node and then the label of that label, so long chains shrink by
    doubling. Only joins and pre-aggregated minima over written tables are used; nothing is collected.
    """
    edges = written(
        links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a")).where("u != v").distinct(), "edges"
    )
    labels = written(edges.groupBy(F.col("u").alias("node")).agg(F.least("node", F.min("v")).alias("label")), "labels")
    while True:
        near = (
            edges.join(labels.withColumnsRenamed({"node": "v", "label": "near"}), "v")
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("near").alias("near"))
        )
        hooked = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        hooked = written(hooked, "hooked")
        if hooked.where("label != old").isEmpty():  # both ends of every link agree
            return labels
        jump = hooked.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = written(hooked.join(jump, "label").select("node", F.least("label", "further").alias("label")), "labels")
