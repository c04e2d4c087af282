"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): label is the smallest node of the component; only nodes with
    an edge appear.

    Every round each node takes the smallest label among its neighbours and then
    the label of that label (pointer jumping), so the number of rounds grows with
    the logarithm of the diameter for chains as well as stars.  A round is a few
    joins and aggregates of the edge list; its result is checkpointed to the shared
    folder.  Node minima are combined map-side before the shuffle, joins on a node
    of very many edges are split by AQE."""
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct().checkpoint()
    labels = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).select(
        "node", F.least("node", "m").alias("label")).checkpoint()
    while True:
        seen = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(
            F.min("label").alias("m"))
        hooked = labels.join(seen, "node").select("node", F.col("label").alias("before"),
                                                  F.least("label", "m").alias("label"))
        # A root takes the smallest label that any of its members has seen.
        roots = hooked.groupBy(F.col("before").alias("node")).agg(F.min("label").alias("r"))
        hooked = hooked.join(roots, "node", "left").select(
            "node", "before", F.least("label", F.coalesce("r", "label")).alias("label"))
        jump = hooked.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = hooked.join(jump, "label").select("node", F.col("up").alias("label"),
                                                (F.col("up") != F.col("before")).alias("changed")).checkpoint()
        moved = new.where("changed").limit(1).count()
        labels = new.drop("changed")
        if not moved:
            return labels
