"""Approximate nearest neighbours by cosine: a forest of random-projection trees.

1. Trees are fitted on at most `SAMPLE` distinct vectors: a node parts its vectors at the median
   of their projection on the direction between two of them, down to `depth`.
2. Every row is placed in its leaf of each tree. Equal vectors are placed once, with the ids
   that can be among the nearest: one more than asked for, smallest first. That loses nothing.
3. A query descends all trees through one priority queue, by the summed squares of the margins
   it is on the wrong side of, until the leaves it has opened hold `share` times the placements of
   one tree, and `LEAST_HELD` of them at least, so that a table of fewer rows is opened more
   widely, up to all of it. As trees overlap, a share of 1 opens well under all vectors. Uniformly
   spread vectors, as in the test tables, need a large share; vectors that cluster need a small one.
4. Leaves, cut into blocks of at most `BLOCK` vectors, meet the queries that opened them. A block
   returns each query's nearest few with exact cosines in double precision; the best of all
   blocks are the result. Nothing larger than a block and its queries is in one task.

Vectors that are null, zero, or hold null or non-finite components take no part. Shorter
vectors count as padded with zeros. Equal scores go to the smaller id. Rows repeated with the same id and
vector count once; null ids take no part; extra columns are ignored; an empty table gives an
empty result; a query without any candidate gives no row.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

TREES = 8
SAMPLE = 20_000
SHARE = 1.0
LEAST_HELD = 2_048  # placements that a search opens at least
LEAF = 4_096  # vectors in a leaf, about, once there are many
LEAST_DEPTH = 7
LEAST_LEAF = 4  # vectors of the sample in a leaf, about
FEW = 64  # so many vectors are one leaf
BLOCK = 8_192


class Forest:
    """Trees as arrays: node k has the children 2k + 1 and 2k + 2; leaves are numbered from the left."""

    def __init__(self, sample: np.ndarray, trees: int, depth: int, seed: int = 4):
        rng = np.random.default_rng(seed)
        self.depth, self.trees = depth, trees
        inner = (1 << depth) - 1
        self.planes = np.zeros((trees, inner, sample.shape[1]))
        self.cuts = np.zeros((trees, inner))
        for tree in range(trees):
            members = {0: np.arange(len(sample))}
            for node in range(inner):
                own = members.pop(node, np.zeros(0, np.int64))
                if len(own) >= 2:
                    a, b = sample[rng.choice(own, 2, replace=False)]
                    plane = a - b
                else:  # too few of the sample reach this node: any direction serves
                    plane = rng.normal(size=sample.shape[1])
                plane /= np.linalg.norm(plane) or 1.0
                along = sample[own] @ plane
                self.planes[tree, node], self.cuts[tree, node] = plane, np.median(along) if len(own) else 0.0
                right = along >= self.cuts[tree, node]
                members[2 * node + 1], members[2 * node + 2] = own[~right], own[right]

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """(rows, trees): the leaf of each vector in each tree."""
        out = np.zeros((len(vectors), self.trees), np.int64)
        for tree in range(self.trees):
            node = np.zeros(len(vectors), np.int64)
            for _ in range(self.depth):
                right = np.einsum("ij,ij->i", vectors, self.planes[tree, node]) >= self.cuts[tree, node]
                node = 2 * node + 1 + right
            out[:, tree] = node - ((1 << self.depth) - 1)
        return out

    def search(self, vector: np.ndarray, sizes: np.ndarray, enough: float) -> list[tuple[int, int]]:
        """(tree, leaf) opened in the order of the shared queue until they hold `enough` vectors."""
        margins = self.planes @ vector - self.cuts
        first_leaf = (1 << self.depth) - 1
        queue = [(0.0, tree, 0) for tree in range(self.trees)]
        opened, held = [], 0
        while queue and held < enough:
            cost, tree, node = heapq.heappop(queue)
            while node < first_leaf:
                m = margins[tree, node]
                near, far = (2 * node + 2, 2 * node + 1) if m >= 0 else (2 * node + 1, 2 * node + 2)
                heapq.heappush(queue, (cost + m * m, tree, far))
                node = near
            if size := sizes[tree, node - first_leaf]:
                opened.append((tree, node - first_leaf))
                held += size
        return opened


def usable(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """id, vector (double) of the rows that take part."""
    vector = F.col(vector_column).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.select(F.col(id_column).cast("long").alias("id"), vector.alias("vector")).where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0))


def _matrix(column: pa.ChunkedArray | pa.Array, dimension: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if len(lengths) and (lengths == dimension).all():
        return flat.reshape(-1, dimension)
    out = np.zeros((len(lengths), dimension))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", under="ignore"):
        scaled = vectors / np.abs(vectors).max(1, keepdims=True)  # neither the largest nor the smallest doubles overflow when squared
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """ids (the `keep` smallest), vector of each distinct vector; combined in each batch, then by salted key."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple, list[int]] = {}
            for i, v in zip(batch.column("id").to_pylist(), batch.column("vector").to_pylist(), strict=True):
                found.setdefault(tuple(v), []).append(i)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([sorted(set(x))[:keep] for x in found.values()], pa.list_(pa.int64())), pa.array(list(map(list, found)), pa.list_(pa.float64()))], ["ids", "vector"])

    smallest = F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids")
    partial = rows.mapInArrow(common.lean(combine), "ids array<long>, vector array<double>")
    salted = partial.groupBy("vector", F.pmod(F.xxhash64("ids"), F.lit(64)).alias("salt")).agg(smallest)
    return salted.groupBy("vector").agg(smallest)


def nearest(rows: DataFrame, queries: DataFrame, k: int = 5, trees: int = TREES, share: float = SHARE, sample: int = SAMPLE, least_depth: int = LEAST_DEPTH) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each query, other rows than itself.

    rows and queries: (id, vector) as of `usable`.
    """
    context = rows.sparkSession.sparkContext
    vectors = distinct_vectors(rows, k + 1).checkpoint()
    n, dimension = vectors.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not n:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    chosen = vectors.orderBy(F.xxhash64("ids"), "ids").limit(sample).select("vector").collect()  # at most `sample` vectors
    fitted = _unit(_matrix(pa.array([r.vector for r in chosen], pa.list_(pa.float64())), dimension))
    depth = min(max(least_depth, math.ceil(math.log2(max(1, n / LEAF)))), int(math.log2(len(fitted) / LEAST_LEAF)) if n > FEW else 0)
    forest = context.broadcast(Forest(fitted, trees, depth))

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        matrix = _matrix(batch.column("vector"), dimension)
        leaf = forest.value.leaves(_unit(matrix))
        codes = leaf + np.arange(trees) * (1 << depth)
        take = pa.array(np.repeat(np.arange(batch.num_rows), trees))
        salt = np.array([hash(tuple(x)) & 0x7FFFFFFF for x in batch.column("ids").to_pylist()], np.int64)
        return pa.RecordBatch.from_arrays([pa.array(codes.ravel()), pa.array(np.repeat(salt, trees)), batch.column("ids").take(take), batch.column("vector").take(take)], ["cell", "salt", "ids", "vector"])

    placed = common.map_batches(vectors, place, "cell long, salt long, ids array<long>, vector array<double>")
    sizes = np.zeros(trees << depth, np.int64)
    for r in placed.groupBy("cell").count().collect():  # one row for each leaf of the broadcast forest
        sizes[r.cell] = r["count"]
    shared = context.broadcast(sizes)
    # a leaf has one block for each BLOCK vectors; the count is looked up where rows are made
    blocks = context.broadcast(np.maximum(1, -(-sizes // BLOCK)))

    def dealt(batch: pa.RecordBatch) -> pa.RecordBatch:
        block = batch.column("salt").to_numpy() % blocks.value[batch.column("cell").to_numpy()]
        return pa.RecordBatch.from_arrays([batch.column("cell"), pa.array(block), batch.column("ids"), batch.column("vector")], ["cell", "block", "ids", "vector"])

    def descend(batch: pa.RecordBatch) -> pa.RecordBatch:
        matrix = _unit(_matrix(batch.column("vector"), dimension))
        takes, cells, parts = [], [], []
        table = shared.value.reshape(trees, -1)
        for row, vector in enumerate(matrix):
            for tree, leaf in forest.value.search(vector, table, max(share * n, LEAST_HELD)):
                cell = (tree << depth) + leaf
                for block in range(blocks.value[cell]):
                    takes.append(row)
                    cells.append(cell)
                    parts.append(block)
        take = pa.array(takes, pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(parts, pa.int64()), batch.column("id").take(take), batch.column("vector").take(take)], ["cell", "block", "query_id", "query"])

    left = common.map_batches(queries, descend, "cell long, block long, query_id long, query array<double>")
    right = common.map_batches(placed, dealt, "cell long, block long, ids array<long>, vector array<double>")

    def rerank(asked: pa.Table, there: pa.Table) -> pa.Table:
        out = ([], [], [])
        if asked.num_rows and there.num_rows:
            units, ids = _unit(_matrix(there.column("vector"), dimension)), there.column("ids").combine_chunks()
            first = np.array([x[0] for x in ids.to_pylist()], np.int64)
            every = ids.to_pylist()
            for at in range(0, asked.num_rows, 256):
                part = asked.slice(at, 256)
                scores = _unit(_matrix(part.column("query"), dimension)) @ units.T
                for row, query_id in zip(scores, part.column("query_id").to_pylist(), strict=True):
                    # one vector more than asked for, as one may be the query's own; ties at the edge all stay
                    edge = np.partition(row, len(row) - k - 1)[len(row) - k - 1] if len(row) > k + 1 else -2.0
                    near = np.flatnonzero(row >= edge - 1e-12)
                    near = near[np.lexsort((first[near], -row[near]))]
                    found = [(float(row[j]), i) for j in near for i in every[j] if i != query_id]
                    for s, i in sorted(found, key=lambda x: (-round(x[0], 12), x[1]))[:k]:
                        out[0].append(query_id)
                        out[1].append(i)
                        out[2].append(s)
        return pa.Table.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["query_id", "vec_id", "score"])

    found = left.groupBy("cell", "block").cogroup(right.groupBy("cell", "block")).applyInArrow(rerank, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 12)), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(common.read(spark, sf_dir, "embeddings"))
    return nearest(rows, rows.where(F.col("id") % 50 == 0).groupBy("id").agg(F.min("vector").alias("vector")))
