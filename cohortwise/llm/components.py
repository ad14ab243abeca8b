"""Connected components of a link table, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node``, ``label`` for every node of ``links`` (columns ``a``, ``b`` of long).

    ``label`` is the smallest node of the component. Each round a node takes the smallest label
    among itself and its neighbours, then the label of that label, so the number of rounds grows
    with the logarithm of the longest path. Rounds are tables in the shared folder; the driver
    sees one number a round. Null ends and loops link nothing; an empty table gives an empty one.
    """
    # written before both directions are taken: computed twice, the links might not be the same
    links = written(links.select("a", "b").filter("a is not null and b is not null and a <> b"))
    edges = written(links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = (
            edges.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("nearest"))
        )
        hop = labels.join(near, "node").select(
            "node", F.col("label").alias("before"), F.least("label", "nearest").alias("label")
        )
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        moved = written(
            hop.join(up, "label").select("node", "before", F.least("label", "above").alias("label"))
        )
        changed = moved.filter("label <> before").limit(1).count()
        labels = moved.select("node", "label")
        if not changed:
            return labels
