"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.llm import common


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (columns a, b): label is the
    smallest node reachable.

    Each round gives a node the least label around it and then that label's own
    label (pointer jumping), written to the shared folder. Sums per node are
    pre-aggregated before the shuffle, so a node with very many links is no
    hot spot. Null nodes and self links are left out.
    """
    both = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = common.written(both.union(both.select("b", "a")).distinct(), "links")
    labels = common.written(both.groupBy(F.col("a").alias("node"))
                            .agg(F.min("b").alias("m"))
                            .select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        around = (both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("l")), "b")
                  .groupBy(F.col("a").alias("node")).agg(F.min("l").alias("l")))
        near = labels.join(around, "node").select("node", F.col("label").alias("old"), F.least("label", "l").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = common.written(near.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        common.dropped(labels)
        if not new.where("old <> label").take(1):
            common.dropped(both)
            return new.select("node", "label")
        path = new._written_path
        labels = new.select("node", "label")
        labels._written_path = path
