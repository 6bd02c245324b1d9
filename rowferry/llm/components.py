"""Connected components of a link table, with labels halved by pointer jumping.

Each round lays its labels down in the shared folder: lineage stays short, a lost
executor costs one round, and both sides of every join are plain scans, so that AQE can
split a hub with very many links. Nothing is collected but one count a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import written


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``links(a, b)`` to ``(node, label)``: the smallest node that each one reaches.

    Nodes without a link are not returned. Self-links and repeated links do no harm.
    """
    both = links.select(F.col("a").alias("src"), F.col("b").alias("dst")).where("src <> dst")
    both = written(both.union(both.select("dst", "src")), f"{name}-links")
    start = both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("least"))
    labels = written(start.select("node", F.least("node", "least").alias("label")), f"{name}-labels")
    while True:
        # the least label next door
        near = (
            both.join(labels.withColumnRenamed("node", "src"), "src")
            .groupBy(F.col("dst").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        step = written(
            labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")), f"{name}-step"
        )
        # then the label of the label
        up = step.select(F.col("node").alias("label"), F.col("label").alias("up"))
        after = written(
            step.join(up, "label").select("node", "old", F.least("label", "up").alias("label")), f"{name}-labels"
        )
        labels = after.select("node", "label")
        if not after.where("old <> label").limit(1).count():
            return labels
