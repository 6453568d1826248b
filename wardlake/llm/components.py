"""Connected components of a graph that is given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardlake.session import write_through


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``label``, the least node of its component, for every node of an edge.

    In each round a node takes the least label among its neighbours and itself,
    and then the label of that label, so that paths shorten by half. Rounds end
    when no label changes. Labels only are aggregated, before and after the
    exchange; a node with very many neighbours costs no more than its edges.
    """
    both = write_through(
        edges.select(F.col(a).alias("x"), F.col(b).alias("y")).union(edges.select(F.col(b), F.col(a))).where("x <> y").distinct(), "edges")
    labels = write_through(
        both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("y")).select("node", F.least("node", "y").alias("label")), "labels")
    while True:
        near = (
            both.join(labels, both["y"] == labels["node"]).groupBy("x").agg(F.min("label").alias("near"))
        )
        taken = labels.join(near, labels["node"] == near["x"]).select("node", "label", F.least("label", "near").alias("new"))
        jumped = taken.alias("t").join(labels.select(F.col("node").alias("via"), F.col("label").alias("far")), F.col("t.new") == F.col("via"), "left")
        step = write_through(jumped.select("node", "label", F.least("new", F.coalesce("far", "new")).alias("new")), "labels")
        changed = step.where("label <> new").limit(1).count()
        labels = step.select("node", F.col("new").alias("label"))
        if not changed:
            return labels
