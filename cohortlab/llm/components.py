"""Connected components of a link table, as repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint_table


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable from each linked id.

    Each round takes the smallest label among neighbours, then the label of
    that label, so that long chains shorten by doubling. Minima are combined
    per task before the shuffle, so a hub costs its tasks one row each; every
    round is written to the shared folder.
    """
    both = links.select(F.col(a).alias("id"), F.col(b).alias("to")) \
        .union(links.select(F.col(b).alias("id"), F.col(a).alias("to"))).where("id <> to").distinct()
    both = checkpoint_table(both, "links")
    labels = checkpoint_table(
        both.groupBy("id").agg(F.least(F.min("to"), F.col("id")).alias("component")), "labels")
    while True:
        near = (both.join(labels.select(F.col("id").alias("to"), F.col("component").alias("seen")), "to")
                .groupBy("id").agg(F.min("seen").alias("seen")))
        hooked = labels.join(near, "id").select(
            "id", F.col("component").alias("old"), F.least("component", "seen").alias("component"))
        hooked = checkpoint_table(hooked, "labels")
        roots = hooked.select(F.col("id").alias("component"), F.col("component").alias("root"))
        jumped = checkpoint_table(hooked.join(roots, "component").select("id", "old", F.col("root").alias("component")),
                                  "labels")
        labels = jumped.select("id", "component")
        if jumped.where("component <> old").isEmpty():
            return labels
