"""Connected components of links between ids, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.session import written


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``label`` (the smallest id it is connected with) for every id in ``links`` (a, b).

    Each round takes the smallest label among the neighbours and then the label of that label, so the number of rounds
    grows with the logarithm of the longest path. Labels are written in each round and never leave the executors. An id
    with many links is folded before the shuffle.
    """
    both = written(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("id").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "id").select("id", "label", F.least("label", "near").alias("low"))
        lower = written(lower, "labels-near")
        up = lower.select(F.col("id").alias("low"), F.col("low").alias("far"))
        jumped = lower.join(up, "low", "left").select(
            "id", F.least("low", F.coalesce("far", "low")).alias("label"), F.col("label").alias("before")
        )
        jumped = written(jumped, "labels-jumped")
        labels = jumped.select("id", "label")
        if jumped.filter("label <> before").isEmpty():
            return labels
