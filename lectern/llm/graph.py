"""Connected components as a loop of joins; nothing of the graph comes to the driver but a sum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node and component (the smallest node reachable), a row for each node that has an edge.

    Each round takes the least label of a node's neighbours and then the label's own label, so labels reach the far end
    of a component in about as many rounds as its diameter has binary digits. Rounds are saved to the shared checkpoint
    folder. Labels only fall, so an unchanged sum ends the loop.
    """
    pairs = edges.select(F.col(a).alias("node"), F.col(b).alias("other")).where("node <> other")
    pairs = saved(pairs.union(pairs.select("other", "node")).distinct())
    labels = saved(pairs.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("component")))
    total = None
    while True:
        last, total = total, labels.agg(F.sum(F.col("component").cast("decimal(38,0)")).alias("s")).first()["s"]
        if last == total:
            return labels
        near = pairs.join(labels.withColumnRenamed("node", "other"), "other").select("node", "component")
        lower = labels.union(near).groupBy("node").agg(F.min("component").alias("component"))
        of_label = labels.select(F.col("node").alias("component"), F.col("component").alias("jump"))
        labels = saved(lower.join(of_label, "component", "left").select("node", F.least("component", F.coalesce("jump", "component")).alias("component")))
