"""Connected components of a table of edges, by smallest label."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

TOGETHER = 1_000_000  # edges that a task holds at once, 16 MB


def smallest_labels(edges: DataFrame, together: int = TOGETHER) -> DataFrame:
    """node, label: the smallest node of its component, for each node that has an edge (a, b).

    Every task first replaces its edges by stars that join the same nodes, `together` at a time;
    these are never more edges. What one task can hold after that is finished there. Else large
    and small stars follow in turn: each node hands its larger neighbours, then its smaller ones,
    over to the smallest node it knows, until every component is one star. There are never more
    edges than at the start, equal ones fall together, and each round is written to the
    checkpoint folder. A node with very many edges is no hot spot (see look_up). Both ways give
    the same labels. Edges from a node to itself and edges with a null end are left out.
    """
    down = common.saved(_starred(edges.where("a <> b").select("a", "b"), together))
    if down.count() <= together:
        return _labels(common.saved(_starred(down.coalesce(1), together)))
    while not _stars(down):
        up = down.select(F.col("b").alias("a"), F.col("a").alias("b"))
        least = down.union(up).groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = common.saved(common.look_up(up, least, ["a"]).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        small = common.look_up(large, large.groupBy("a").agg(F.min("b").alias("m")), ["a"])
        down = common.saved(small.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where("a > b").distinct())
    return _labels(down)


def _labels(stars: DataFrame) -> DataFrame:
    return stars.select(F.col("a").alias("node"), F.col("b").alias("label")).union(stars.select("b", "b").distinct())


def _stars(down: DataFrame) -> bool:
    """Whether every node has one edge down, to a node that has none."""
    ends = down.select(F.col("a").alias("node"), F.lit(0).alias("centre")).union(down.select(F.col("b").alias("node"), F.lit(1).alias("centre")))
    per = ends.groupBy("node").agg(F.count(F.when(F.col("centre") == 0, 1)).alias("downs"), F.max("centre").alias("centre"))
    return not per.where("downs > 1 OR downs = 1 AND centre = 1").limit(1).count()


def _starred(edges: DataFrame, together: int) -> DataFrame:
    """Edges (a, b) to the smallest node of each component that a task sees in up to `together` of its edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if held and sum(b.num_rows for b in held) + batch.num_rows > together:
                yield _star(held)
                held = []
            held.append(batch)
        if held:
            yield _star(held)

    return edges.mapInArrow(common.lean(run), "a long, b long")


def _star(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches)
    nodes, roots = roots_of(table.column("a").to_numpy(), table.column("b").to_numpy())
    apart = nodes != roots
    return pa.RecordBatch.from_arrays([pa.array(nodes[apart], pa.int64()), pa.array(roots[apart], pa.int64())], ["a", "b"])


def roots_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges and the smallest node of each one's component; rounds halve the open components."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = np.arange(len(nodes))
    while True:
        ends = label[at].reshape(2, -1)
        low, high = ends.min(0), ends.max(0)
        if (low == high).all():
            return nodes, nodes[label]
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]
