"""Connected components of an edge table by label propagation with pointer jumping, on DataFrames alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """v, label for each end of ``edges`` (a long, b long): label is the smallest vertex that v reaches.

    Each round takes the smallest label among a vertex and its neighbours and then the label of that label, so the
    rounds grow with the logarithm of a component's diameter. Labels are written to the shared scratch folder every
    round. The aggregates combine before their exchange and the joins are plain equi-joins, so that a vertex with
    very many neighbours is split by adaptive execution. An empty table gives no rows.
    """
    both = materialise(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct())
    labels = materialise(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("label")))
    for _ in range(max_rounds):
        near = both.join(labels.select(F.col("v").alias("b"), "label"), "b").groupBy(F.col("a").alias("v")).agg(F.min("label").alias("near"))
        moved = labels.join(near, "v").select("v", F.col("label").alias("old"), F.least("label", "near").alias("to"))
        jump = moved.select(F.col("v").alias("to"), F.col("to").alias("next"))
        new = materialise(moved.join(jump, "to").select("v", "old", F.least("to", "next").alias("label")))
        if new.filter("label <> old").isEmpty():
            return new.select("v", "label")
        labels = new.select("v", "label")
    raise RuntimeError("labels did not settle")
