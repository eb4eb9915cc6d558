"""Connected components by iterative Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesflow.llm.common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, root) for every id in ``edges`` (a, b: long): root is the smallest id of its component.

    Each round every id takes the smallest root among its neighbours, then its
    root's root; both are joins and aggregates over edges, written each round.
    Rounds grow with the logarithm of the longest path in practice; they go on
    until nothing changes (roots only fall, so that they end).
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = materialize(both, "cc-edges")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("id"), F.least("a", "least").alias("root")),
                         "cc-labels")
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("root").alias("near"))
        met = materialize(labels.join(near, labels["id"] == near["a"])
                          .select("id", F.least("root", "near").alias("root"), F.col("root").alias("was")), "cc-met")
        up = met.select(F.col("id").alias("up"), F.col("root").alias("higher"))
        labels = materialize(met.join(up, met["root"] == up["up"]).select("id", "was", F.least("root", "higher").alias("root")), "cc-labels")
        if labels.where("root <> was").isEmpty():
            return labels.select("id", "root")
        labels = labels.select("id", "root")
