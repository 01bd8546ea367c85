"""Connected components of an edge table (for Q7), in a number of jobs that does not follow the longest chain.

Each task first reduces its own edges to a forest (connectivity stays, cliques shrink to trees).  While more edges are
left than one task may hold (``TASK_EDGES``), the graph is contracted by joins: every node goes to the neighbour, or
itself, with the smallest random rank of the round, which leaves a constant share of the nodes however they are
chained.  What fits into one task is solved there; the labels are carried back through the contractions by joins.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acadlake.session import cut_lineage

TASK_EDGES = 1_000_000

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def labels_of(a, b):
    """(nodes, label of each): the smallest node of its component, for arrays of edge ends."""
    import numpy as np

    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        # hook the larger label's own root, then shorten all paths
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        new = new[label]
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def _numbers(batches):
    import numpy as np

    parts = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)) for b in batches]
    return tuple(np.concatenate([p[i] for p in parts]) if parts else np.empty(0, np.int64) for i in (0, 1))


def forests(edges: DataFrame) -> DataFrame:
    """Edges that connect what ``edges`` (a, b) connect: at most one a node and batch."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            nodes, label = labels_of(*_numbers([batch]))
            keep = nodes != label
            yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(label[keep])], ["a", "b"])

    return edges.select("a", "b").mapInArrow(run, "a bigint, b bigint").distinct()


def _in_one_task(edges: DataFrame) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        nodes, label = labels_of(*_numbers(list(batches)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(label)], ["node", "label"])

    return edges.coalesce(1).mapInArrow(run, "node bigint, label bigint")


def components(edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """(a, b) -> (node, label): one label for all nodes of a component, for every node that has an edge."""
    left, steps = cut_lineage(forests(edges.where("a <> b")), "graph-forest"), []
    while left.count() > task_edges:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = F.struct(F.xxhash64(F.col("b"), F.lit(len(steps))).alias("r"), F.col("b").alias("to"))
        own = F.struct(F.xxhash64(F.col("a"), F.lit(len(steps))).alias("r"), F.col("a").alias("to"))
        goes = both.groupBy("a").agg(F.min(rank).alias("m")).select(
            F.col("a").alias("node"), F.least(F.col("m"), own)["to"].alias("label"))
        goes = cut_lineage(goes, "graph-step")
        steps.append(goes)
        ends = left
        for end in ("a", "b"):
            ends = ends.join(goes.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("label", end)
        left = cut_lineage(forests(ends.where("a <> b")), "graph-forest")
    out = cut_lineage(_in_one_task(left), "graph-labels")
    for goes in reversed(steps):
        far = out.select(F.col("node").alias("via"), F.col("label").alias("far"))
        out = goes.join(far, goes["label"] == far["via"], "left").select("node", F.coalesce("far", "label").alias("label"))
    return out
