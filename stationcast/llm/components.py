"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.session import stage

# Links, in both directions, that one task handles.
PER_TASK = 200_000


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it is connected with, for all ends of links.

    ``links`` has the columns ``a`` and ``b``. Every round takes the smallest label among the
    neighbours (a combining aggregate, so a hub sends one row per task) and then the label of
    that label, so long chains halve with each round. Labels are written to the shared folder
    after every round, by no more tasks than the links need; nothing is gathered but their number
    and whether any label still changed.
    """
    tasks = 1 + 2 * links.count() // PER_TASK
    ends = links.select("a", "b").union(links.select("b", "a"))
    both = stage(ends.toDF("node", "other").distinct().coalesce(tasks), "links")
    labels = both.select("node", F.col("node").alias("component")).distinct()
    labels = stage(labels.coalesce(tasks), "labels")
    while True:
        others = labels.select(F.col("node").alias("other"), F.col("component").alias("theirs"))
        nearest = both.join(others, "other").groupBy("node").agg(F.min("theirs").alias("nearest"))
        lowered = stage(
            labels.join(nearest, "node").select(
                "node",
                F.least("component", "nearest").alias("component"),
                F.col("component").alias("before"),
            ).coalesce(tasks),
            "lowered",
        )
        roots = lowered.select(F.col("node").alias("component"), F.col("component").alias("root"))
        labels = stage(
            lowered.join(roots, "component")
            .select("node", F.col("root").alias("component"), "before")
            .coalesce(tasks),
            "labels",
        )
        if labels.where("component < before").isEmpty():
            return labels.select("node", "component")
