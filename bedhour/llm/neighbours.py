"""Operator 7: nearest neighbours by vantage-point trees, one per shard.

Vectors are dealt to shards of about ``shard_rows`` by a hash of their id. A task
builds one shard's tree: a vantage point, the median distance to it, the nearer
and the farther half below. For the inner product, every vector gets one more
component that brings it to the largest length, so that the largest product is
the smallest distance and the triangle inequality holds. The trees are written
once. Queries are packed in blocks; each block meets each tree, and all queries
of a block go down the tree together: into the half on their side first, then
into the other half if ``|distance - median| <= factor * (distance of the k-th
found so far)``. Factor 1 is exact; smaller factors skip more.

Equal vectors of a shard share one place in the tree with the smallest ids, as
many as can be asked for, so a very common vector costs nothing more.

Defined results: rows with a null id, and vectors that are null, empty, zero or
hold null or non-finite components take no part; vectors of different lengths
are not compared; rows of one id count as one row (the first by their bytes);
with fewer than k candidates all are returned; further columns are ignored; no
vectors or no queries give no rows.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Stage, in_tasks, on_workers

SHARD_ROWS = 8192
BLOCK_ROWS = 512
LEAF = 256
FACTOR = 0.5


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``id, vector`` (doubles), ``dim`` of the rows that take part."""
    v = F.col("vector")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(
        F.col("id").isNotNull() & v.isNotNull() & ~F.coalesce(odd, F.lit(True)) & F.exists(v, lambda x: x != 0)
    ).withColumn("dim", F.size("vector"))


class Tree:
    """A vantage-point tree over distinct vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float, keep: int, seed: int = 7):
        # One row per id, then one place per distinct vector with its smallest ids.
        order = np.lexsort((*vectors.T[::-1], ids))
        ids, vectors = ids[order], vectors[order]
        first = np.ones(len(ids), bool)
        first[1:] = ids[1:] != ids[:-1]
        ids, vectors = ids[first], vectors[first]
        self.vectors, place = np.unique(vectors + 0.0, axis=0, return_inverse=True)
        place = place.reshape(-1)
        order = np.lexsort((ids, place))
        starts = np.searchsorted(place[order], np.arange(len(self.vectors)))
        ends = np.searchsorted(place[order], np.arange(len(self.vectors)), side="right")
        self.ids = [ids[order[a : min(b, a + keep)]] for a, b in zip(starts, ends, strict=True)]
        lengths = (self.vectors**2).sum(axis=1)
        lift = np.sqrt(np.maximum(longest**2 - lengths, 0.0))
        self.points = np.concatenate([self.vectors, lift[:, None]], axis=1)
        self.squares = (self.points**2).sum(axis=1)
        self.nodes: list[tuple] = []
        if len(self.points):
            self._build(np.arange(len(self.points)), np.random.default_rng(seed))

    def _build(self, rows: np.ndarray, random: np.random.Generator) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        if len(rows) <= LEAF:
            self.nodes[at] = (rows,)
            return at
        pick = int(random.integers(len(rows)))
        vantage = rows[pick]
        rest = np.delete(rows, pick)
        far = np.sqrt(np.maximum(((self.points[rest] - self.points[vantage]) ** 2).sum(axis=1), 0.0))
        half = len(rest) // 2
        order = np.argsort(far, kind="stable")
        median = float(far[order[half]])
        self.nodes[at] = (vantage, median, self._build(rest[order[:half]], random), self._build(rest[order[half:]], random))
        return at

    def search(self, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Places and distances of the k nearest found per query (-1: none)."""
        points = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
        squares = (points**2).sum(axis=1)
        place = np.full((len(queries), k), -1, np.int64)
        far = np.full((len(queries), k), np.inf)

        def distances(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
            d = squares[q][:, None] + self.squares[rows][None, :] - 2 * points[q] @ self.points[rows].T
            return np.sqrt(np.maximum(d, 0.0))

        def offer(q: np.ndarray, rows: np.ndarray, d: np.ndarray) -> None:
            better = (d < far[q, -1][:, None]).any(axis=1)
            q, d = q[better], d[better]
            if len(q):
                all_far = np.concatenate([far[q], d], axis=1)
                all_place = np.concatenate([place[q], np.broadcast_to(rows, d.shape)], axis=1)
                order = np.argsort(all_far, axis=1, kind="stable")[:, :k]
                far[q] = np.take_along_axis(all_far, order, 1)
                place[q] = np.take_along_axis(all_place, order, 1)

        def visit(node: int, q: np.ndarray) -> None:
            if not len(q):
                return
            content = self.nodes[node]
            if len(content) == 1:
                offer(q, content[0], distances(q, content[0]))
                return
            vantage, median, near, other = content
            d = distances(q, np.array([vantage]))
            offer(q, np.array([vantage]), d)
            d = d[:, 0]
            inner = d < median
            visit(near, q[inner])
            visit(other, q[~inner])
            again = np.abs(d - median) <= factor * far[q, -1]
            visit(other, q[inner & again])
            visit(near, q[~inner & again])

        if self.nodes:
            visit(0, np.arange(len(queries)))
        return place, far


def build_trees(rows: DataFrame, shards: int, longest: float, keep: int) -> DataFrame:
    """``dim, shard, tree`` (pickled): the index over every row."""

    def build(part: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack(part["vector"].to_numpy())
        tree = Tree(part["id"].to_numpy(np.int64), vectors, longest, keep)
        return pd.DataFrame({"dim": [part["dim"].iloc[0]], "shard": [part["shard"].iloc[0]], "tree": [pickle.dumps(tree)]})

    on_workers(rows.sparkSession)
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    return dealt.groupBy("dim", "shard").applyInPandas(build, "dim int, shard int, tree binary")


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    factor: float = FACTOR,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k rows of ``vectors`` nearest to
    each row of ``queries``, itself left out."""
    rows = usable(vectors, vec_id, vector)
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    size = rows.agg(F.count("*").alias("n"), F.max(square).alias("longest")).first()
    shards = max(1, math.ceil(size["n"] / shard_rows))
    trees = Stage(build_trees(rows, shards, math.sqrt(size["longest"] or 0.0), k + 1), "trees")

    asked = usable(queries, vec_id, vector)
    blocks = max(1, math.ceil(asked.count() / block_rows))
    packed = (
        asked.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(blocks)).cast("int"))
        .groupBy("dim", "block")
        .agg(F.collect_list(F.struct("id", "vector")).alias("queries"))
    )
    met = packed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).join(trees.df, ["dim", "shard"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                asked_rows = batch.column(0)[i].values
                ids = asked_rows.field("id").to_numpy(zero_copy_only=False).astype(np.int64)
                points = asked_rows.field("vector").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
                order = np.lexsort((*points.T[::-1], ids))
                order = order[np.concatenate([[True], ids[order[1:]] != ids[order[:-1]]])]
                ids, points = ids[order], points[order]
                tree: Tree = pickle.loads(batch.column(1)[i].as_py())
                place, _ = tree.search(points, k + 1, factor)
                found: tuple[list, list, list] = ([], [], [])
                for q in range(len(ids)):
                    places = place[q][place[q] >= 0]
                    # The measure itself, on the vectors as they came, summed in one fixed order.
                    scores = (tree.vectors[places] * points[q]).sum(axis=1)
                    near = [(-s, int(v)) for s, p in zip(scores.tolist(), places, strict=True) for v in tree.ids[p] if v != ids[q]]
                    for s, v in sorted(near)[:k]:
                        found[0].append(int(ids[q]))
                        found[1].append(v)
                        found[2].append(-s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64())],
                    ["query_id", "vec_id", "score"],
                )

    near = met.select("queries", "tree").transform(in_tasks, search, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
