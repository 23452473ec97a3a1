"""Connected components of a link table, by repeated minimum labels and label jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """node, component for every node of links (a, b): the smallest node reachable. Nodes without links are not listed.

    Each round writes its labels to the shared folder, so a round survives lost executors and the plan stays short.
    Links between a node and itself are allowed, repeated ones cost nothing more; no links give no rows.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        nearest = both.join(of_b, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        lower = labels.join(nearest, "node").select("node", F.least("label", "near").alias("next"), "label")
        # The label of the label: halves the length of long chains.
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("beyond"))
        moved = stored(lower.join(jump, "next", "left").select(
            "node", F.least("next", "beyond").alias("label"), (F.least("next", "beyond") < F.col("label")).alias("changed")), "labels")
        labels = moved.select("node", "label")
        if not moved.where("changed").take(1):
            return labels.withColumnRenamed("label", "component")
