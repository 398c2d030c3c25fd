"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.session import written


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node of each component, for every node that has a link.

    Every round takes the least label among the neighbours (combined before the shuffle) and then the label of
    that label, so chains shrink by more than half. Each round is written to the shared folder.
    """
    both = written(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = written(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")),
        "labels",
    )
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("m"))
        least = labels.join(near, F.col("node") == F.col("a"), "left").select(
            "node", F.col("label").alias("old"), F.least("label", "m").alias("label")
        )
        step = written(least, "labels")
        up = step.select(F.col("node").alias("up"), F.col("label").alias("top"))
        labels = written(
            step.join(up, F.col("label") == F.col("up"), "left").select(
                "node", F.least("label", "top").alias("label"), (F.least("label", "top") != F.col("old")).alias("moved")
            ),
            "labels",
        )
        if not labels.filter("moved").limit(1).count():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
