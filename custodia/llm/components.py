"""Connected components of a link table by minimum labels and pointer jumping, on tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import spread_join, stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); the label is the smallest node of the component.

    Each round takes the smallest label among a node's neighbours, then the label of that label, and is written
    to the shared folder, so a round is never computed twice. Minima are taken per task before they move, and both joins
    deal the rows of a very frequent key over several tasks: the centre of a star, and the label of a large component.
    """
    links = stored(links, "given-links")  # read twice
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    both = stored(both.distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = (
            spread_join(both, labels.select(F.col("node").alias("b"), F.col("label").alias("near")), "b", "a")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("near").alias("near"))
        )
        low = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        target = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        moved = stored(
            spread_join(stored(low, "low-labels"), target, "low", "node").select("node", F.least("low", "far").alias("label"), (F.least("low", "far") < F.col("label")).alias("moved")),
            "labels",
        )
        labels = moved.select("node", "label")
        if moved.where("moved").isEmpty():
            return labels
