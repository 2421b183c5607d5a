"""Connected components of a distributed edge table, by contraction to the smallest neighbour."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.llm.common import materialize

#: Once no more edges than this are left, one task finishes: rounds over small tables are mostly the cost of writing files.
FEW = 200_000


def least_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Of nodes 0 to n - 1: the smallest node of each one's component. Roots hook onto smaller ones, then paths are halved."""
    label = np.arange(n)
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while (label != (up := label[label])).any():
            label = up


def _in_one_task(edges: DataFrame) -> DataFrame:
    """(node, label) of a stored table of few edges."""
    kind = edges.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        ends = pa.concat_arrays([c for name in ("a", "b") for c in table.column(name).chunks])
        nodes = pc.unique(ends)
        nodes = nodes.take(pc.sort_indices(nodes))
        at = pc.index_in(ends, nodes).to_numpy()
        label = least_labels(at[: len(at) // 2], at[len(at) // 2 :], len(nodes))
        yield from pa.table({"node": nodes, "label": nodes.take(pa.array(label))}).to_batches(max_chunksize=10_000)

    return edges.select("a", "b").coalesce(1).mapInArrow(run, f"node {kind}, label {kind}")


def components(edges: DataFrame, few: int = FEW) -> DataFrame:
    """(node, label) for every node of edges (a, b); label is the same for the nodes of a component.

    Each round maps a node to the smallest of itself and its neighbours and moves the edges along; the
    number of nodes left falls by a constant factor a round. When at most `few` edges are left, one task
    does the rest. Nothing but row counts reaches the driver.
    Self loops and repeated edges are harmless; an empty table gives an empty result."""
    edges = materialize(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = None
    while n := edges.count():
        if n <= few:
            step = materialize(_in_one_task(edges), "step")
            if labels is None:
                return step
            moved = step.select(F.col("node").alias("label"), F.col("label").alias("_next"))
            return materialize(labels.join(moved, "label", "left").select("node", F.coalesce("_next", "label").alias("label")), "labels")
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "step")
        if labels is None:
            labels = step
        else:
            moved = step.select(F.col("node").alias("label"), F.col("label").alias("_next"))
            labels = materialize(labels.join(moved, "label", "left").select("node", F.coalesce("_next", "label").alias("label")), "labels")
        left = step.select(F.col("node").alias("a"), F.col("label").alias("_a"))
        right = step.select(F.col("node").alias("b"), F.col("label").alias("_b"))
        moved = edges.join(left, "a").join(right, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        edges = materialize(moved.where("a <> b").distinct(), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")) if labels is None else labels
