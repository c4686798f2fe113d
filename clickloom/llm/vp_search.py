"""Nearest neighbours with a vantage-point tree for every shard of the vectors."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import shared_table


@dataclass(frozen=True)
class VpParams:
    """A branch is left out if `factor` times its least distance exceeds the k-th best so far: 1 is
    exact, more searches less. Shards hold about `shard_rows` vectors, leaves at most `leaf_rows`,
    and about `query_rows` queries are searched in a shard at a time.
    """

    k: int = 10
    factor: float = 1.5
    shard_rows: int = 8192
    leaf_rows: int = 64
    query_rows: int = 2048


class VpTree:
    """Nodes as arrays: vantage point, place of its two children, and the range of distances in each.

    The vantage point is the vector farthest from the mean; the others are halved by distance from
    it, in order of (distance, place), so that equal vectors split as well as any.
    """

    def __init__(self, vectors: np.ndarray, leaf_rows: int):
        self.vectors, self.leaf_rows = vectors, leaf_rows
        self.order = np.arange(len(vectors))
        self.nodes: list[tuple] = []
        if len(vectors):
            self._build(0, len(vectors))

    def _build(self, begin: int, end: int) -> int:
        node = len(self.nodes)
        self.nodes.append((begin, end, -1, -1, -1, 0.0, 0.0, 0.0, 0.0))
        if end - begin > self.leaf_rows:
            rows = self.order[begin:end]
            point = rows[int(distances(self.vectors[rows].mean(axis=0)[None], self.vectors[rows])[0].argmax())]
            away = distances(self.vectors[point][None], self.vectors[rows])[0]
            by = np.argsort(away, kind="stable")
            self.order[begin:end], away = rows[by], away[by]
            half = (end - begin) // 2
            if away[-1] > away[0]:
                near, far = self._build(begin, begin + half), self._build(begin + half, end)
                self.nodes[node] = (begin, end, int(point), near, far, away[0], away[half - 1], away[half], away[-1])
        return node


def distances(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, each pair on its own, so equal pairs give equal values."""
    out = np.empty((len(queries), len(vectors)))
    for at in range(0, len(queries), 128):
        gap = queries[at : at + 128, None, :] - vectors[None, :, :]
        out[at : at + 128] = np.sqrt(np.einsum("ijk,ijk->ij", gap, gap))
    return out


def search(tree: VpTree, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, params: VpParams):
    """The k nearest (distance, id) of every query; infinite distance where there are fewer."""
    n, k = len(queries), params.k
    best, best_ids = np.full((n, k), np.inf), np.full((n, k), np.iinfo(np.int64).max)

    def take(own: np.ndarray, begin: int, end: int) -> None:
        rows = tree.order[begin:end]
        for at in range(0, len(rows), 512):  # a leaf of equal vectors may be long
            some = rows[at : at + 512]
            far = distances(queries[own], tree.vectors[some])
            far[query_ids[own][:, None] == ids[some][None, :]] = np.inf
            value = np.concatenate([best[own], far], axis=1)
            named = np.concatenate([best_ids[own], np.broadcast_to(ids[some], far.shape)], axis=1)
            by = np.lexsort((named, value), axis=1)[:, :k]
            best[own], best_ids[own] = np.take_along_axis(value, by, 1), np.take_along_axis(named, by, 1)

    def visit(node: int, own: np.ndarray) -> None:
        begin, end, point, near, far, near_low, near_high, far_low, far_high = tree.nodes[node]
        if point < 0:
            take(own, begin, end)
            return
        away = distances(queries[own], tree.vectors[point][None])[:, 0]
        to_near = np.maximum(np.maximum(near_low - away, away - near_high), 0)
        to_far = np.maximum(np.maximum(far_low - away, away - far_high), 0)
        first = to_near <= to_far
        for child, mine in ((near, first), (far, ~first)):
            if mine.any():
                visit(child, own[mine])
        for child, mine, least in ((far, first, to_far), (near, ~first, to_near)):
            # Ties at the k-th distance go to the smaller id, so an equal bound is still searched.
            worth = mine & (params.factor * least <= best[own, k - 1] * (1 + 1e-12))
            if worth.any():
                visit(child, own[worth])

    if n and len(tree.nodes):
        visit(0, np.arange(n))
    return best, best_ids


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, embedding of vectors that take part: not null, not zero, all components finite.

    A repeated vec_id counts once, with its least vector.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = rows.where(F.exists("embedding", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def nearest(vectors: DataFrame, queries: DataFrame, params: VpParams = VpParams()) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest vectors, but for the one with its id.

    `vectors` and `queries` have vec_id and embedding, as `usable_vectors` gives them. Nearness is
    Euclidean distance; ties go to the smaller vec_id. Vectors of another length than the query's
    are no candidates. With fewer candidates, all are returned; no query or vector, no row.
    Shards are dealt by hash of vec_id, so no vector or label can fill one; queries come to every
    shard in blocks, and a shard answers with k rows a query.
    """
    vectors = shared_table(vectors.withColumn("size", F.size("embedding")), "vectors")
    queries = shared_table(queries.withColumn("size", F.size("embedding")), "queries")
    n_shards = max(1, -(-vectors.count() // params.shard_rows))
    n_blocks = max(1, -(-queries.count() // params.query_rows))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        def matrix(table: pa.Table) -> np.ndarray:
            return table.column("embedding").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)

        empty = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not left.num_rows or not right.num_rows:
            return empty.empty_table()
        left, right = left.sort_by("vec_id"), right.sort_by("vec_id")
        tree, ids = VpTree(matrix(left), params.leaf_rows), left.column("vec_id").to_numpy()
        query_ids = right.column("vec_id").to_numpy()
        best, best_ids = search(tree, ids, matrix(right), query_ids, params)
        found = np.isfinite(best)
        return pa.table(
            [np.repeat(query_ids, found.sum(axis=1)), best_ids[found], best[found]], schema=empty
        )

    def dealt(parts: int):
        return F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")

    every_block, every_shard = (F.explode(F.sequence(F.lit(0), F.lit(x - 1))) for x in (n_blocks, n_shards))
    sharded = vectors.select("vec_id", "embedding", "size", dealt(n_shards).alias("shard"), every_block.alias("block"))
    asked = queries.select("vec_id", "embedding", "size", every_shard.alias("shard"), dealt(n_blocks).alias("block"))
    keys = ["size", "shard", "block"]
    found = sharded.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= params.k)
    return ranked.select("query_id", "rank", "vec_id", "score")
