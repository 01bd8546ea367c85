"""Connected components of an edge table by smallest labels (DataFrame joins; every round is written and reread)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acadlake.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, label): the smallest node reachable, for every node that has an edge.

    A round gives each node the smallest label among its neighbours and then that label's own label, so the distance
    to the smallest node about halves.  Messages are pre-aggregated per task; a node with very many edges is an
    ordinary skewed join key.  Only one number a round comes back to the driver.
    """
    both = cut_lineage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .filter("a <> b").distinct(), "cc-edges")
    labels = cut_lineage(both.groupBy(F.col("a").alias("node"))
                         .agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("label")),
                         "cc-labels")
    while True:
        heard = both.join(labels, both["a"] == labels["node"]).groupBy(F.col("b").alias("to")).agg(
            F.min("label").alias("heard"))
        near = labels.join(heard, labels["node"] == heard["to"], "left").select(
            "node", "label", F.least("label", F.coalesce("heard", "label")).alias("now"))
        near = cut_lineage(near, "cc-near")
        jump = near.select(F.col("node").alias("via"), F.col("now").alias("far"))
        step = near.join(jump, near["now"] == jump["via"], "left").select(
            "node", F.least("now", F.coalesce("far", "now")).alias("label"), F.col("label").alias("was"))
        step = cut_lineage(step, "cc-step")
        labels = step.select("node", "label")
        if not step.filter(F.col("label") != F.col("was")).limit(1).count():
            return labels
