"""Connected components of an edge table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.llm.util import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that is reachable. ``edges``: columns a and b.

    Every round takes the smallest label among the neighbours, then the label of that label, so that
    rounds grow with the logarithm of a component's diameter. Each round is written to the shared
    folder; labels and edges stay distributed.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = saved(both.where("a != b").distinct(), "edges")
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        around = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(around, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        lower = saved(lower, "labels")
        jump = lower.select(F.col("node").alias("at"), F.col("label").alias("beyond"))
        labels = saved(
            lower.join(jump, F.col("label") == F.col("at"), "left").select(
                "node", "old", F.least("label", F.coalesce("beyond", "label")).alias("label")
            ),
            "labels",
        )
        if labels.where("label != old").isEmpty():
            return labels.select("node", "label")
