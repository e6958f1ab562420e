"""Exact top-k by inner product: a ball tree per shard, searched by branch and bound.

A node of the tree is a ball around its rows.  The inner product of a query q with any row of a
ball of centre c and radius r is at most q.c + |q| r.  Children are visited in the order of this
bound, and a node whose bound is below the query's current k-th score is not visited.  The k-th
score is shared: the nodes of a shard share it while searching, and the score found in a query's
first shard is the floor it starts from in all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.llm.common import stored
from maskwright.llm.vectors import (
    RESULT_SCHEMA, Rows, best, clean, results, scatter, search_shards, shard_of,
)

# Rows of one shard, about; one task holds a shard and its tree.
SHARD_ROWS = 8192
LEAF = 128
SCHEMA = RESULT_SCHEMA.format("bigint")
_LOWEST = np.iinfo(np.int64).min
_NO_ID = np.iinfo(np.int64).max


class Node(NamedTuple):
    centre: np.ndarray
    radius: float
    begin: int
    end: int
    left: Node | None
    right: Node | None


class BallTree:
    """A tree over integer vectors; halves are split across the direction of their spread."""

    def __init__(self, rows: Rows, leaf: int = LEAF) -> None:
        self.leaf = leaf
        self.points = rows.vectors.astype(np.float64)
        order = np.arange(len(rows.row))
        self.root = self._grow(order, 0, len(order))
        self.row, self.vec_id = rows.row[order], rows.vec_id[order]
        self.exact, self.points = rows.vectors[order], self.points[order]
        self.largest = float(np.abs(self.points).max(initial=0))

    def _grow(self, order: np.ndarray, begin: int, end: int) -> Node:
        points = self.points[order[begin:end]]
        centre = points.mean(axis=0)
        distances = np.linalg.norm(points - centre, axis=1)
        radius = float(distances.max())
        if end - begin <= self.leaf or radius == 0:
            return Node(centre, radius, begin, end, None, None)
        far = points[distances.argmax()]
        other = points[np.linalg.norm(points - far, axis=1).argmax()]
        middle = (end - begin) // 2
        split = np.argpartition(points @ (other - far), middle)
        order[begin:end] = order[begin:end][split]
        return Node(
            centre, radius, begin, end,
            self._grow(order, begin, begin + middle), self._grow(order, begin + middle, end),
        )

    def bounds(self, node: Node, queries: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Upper bounds of the inner products, with room for rounding."""
        slack = 1e-9 * norms * (np.linalg.norm(node.centre) + node.radius) + 1e-6
        return queries @ node.centre + norms * node.radius + slack


class _Search:
    """The state of one block of queries in one shard."""

    def __init__(self, tree: BallTree, queries: Rows, k: int) -> None:
        self.tree, self.k = tree, k
        self.queries = queries
        self.points = queries.vectors.astype(np.float64)
        self.norms = np.linalg.norm(self.points, axis=1)
        n = len(queries.row)
        self.scores = np.full((n, k), _LOWEST)
        self.ids = np.full((n, k), _NO_ID)
        self.rows = np.full((n, k), -1)
        # The score that a row must reach; NaN where nothing is known yet.
        self.floors = np.where(np.isnan(queries.floor), -np.inf, queries.floor)
        reach = self.tree.largest * float(np.abs(self.points).max(initial=0))
        self.in_floats = reach * max(1, self.points.shape[1]) < 2.0**52

    def visit(self, node: Node, active: np.ndarray) -> None:
        """Search below a node for those active queries whose bound reaches their k-th score."""
        bounds = self.tree.bounds(node, self.points[active], self.norms[active])
        active = active[bounds >= self.floors[active]]
        if not len(active):
            return
        if node.left is None:
            self._leaf(node, active)
            return
        points, norms = self.points[active], self.norms[active]
        left_first = self.tree.bounds(node.left, points, norms) >= self.tree.bounds(
            node.right, points, norms
        )
        self.visit(node.left, active[left_first])
        self.visit(node.right, active)
        self.visit(node.left, active[~left_first])

    def _products(self, node: Node, active: np.ndarray) -> np.ndarray:
        span = slice(node.begin, node.end)
        if self.in_floats:
            return np.rint(self.points[active] @ self.tree.points[span].T).astype(np.int64)
        wide = self.queries.vectors[active].astype(object) @ self.tree.exact[span].T.astype(object)
        return wide.astype(np.int64)

    def _leaf(self, node: Node, active: np.ndarray) -> None:
        # A ball of equal vectors is a leaf of any size: it is taken in steps.
        for begin in range(node.begin, node.end, 4096):
            part = node._replace(begin=begin, end=min(begin + 4096, node.end))
            scores = self._products(part, active)
            own = self.queries.row[active][:, None] == self.tree.row[None, part.begin:part.end]
            wanted = (scores >= self.floors[active][:, None]) & ~own
            some = wanted.any(axis=1)
            self._merge(part, active[some], np.where(wanted, scores, _LOWEST)[some], wanted[some])

    def _merge(self, part: Node, who: np.ndarray, scores: np.ndarray, wanted: np.ndarray) -> None:
        if not len(who):
            return
        span = slice(part.begin, part.end)
        ids = np.where(wanted, self.tree.vec_id[None, span], _NO_ID)
        rows = np.where(wanted, self.tree.row[None, span], -1)
        scores = np.concatenate([self.scores[who], scores], axis=1)
        ids = np.concatenate([self.ids[who], ids], axis=1)
        rows = np.concatenate([self.rows[who], rows], axis=1)
        # Best first; empty places (the lowest score, the largest id) last.
        order = np.lexsort((ids, -scores.astype(np.float64) if self.in_floats else ~scores))
        order = order[:, :self.k]
        self.scores[who] = np.take_along_axis(scores, order, axis=1)
        self.ids[who] = np.take_along_axis(ids, order, axis=1)
        self.rows[who] = np.take_along_axis(rows, order, axis=1)
        kth = np.where(self.rows[who][:, -1] >= 0, self.scores[who][:, -1], -np.inf)
        self.floors[who] = np.maximum(self.floors[who], kth)


def _searched(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    def search(tree: BallTree, queries: Rows) -> pa.RecordBatch:
        state = _Search(tree, queries, k)
        state.visit(tree.root, np.arange(len(queries.row)))
        return results(queries, state.rows, state.ids, state.scores, state.rows >= 0)

    return search_shards(batches, BallTree, search)


def as_integers(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """Every component x as floor(scale * x), computed in doubles."""
    parts = F.transform("vector", lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return vectors.withColumn("vector", parts)


def top_k(
    candidates: DataFrame, queries: DataFrame, k: int, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of every query, exactly.

    Both frames hold (row, vec_id, vector of whole numbers); a candidate with the query's ``row``
    is the query itself and left out.  Vectors meet only those of equal length.  A query first
    searches the shard of its own row, and then all others with the k-th score found there.
    Ties go to the smaller id; with fewer than k candidates all are returned.
    """
    shards = max(1, -(-candidates.count() // shard_rows))
    home = queries.withColumn("targets", F.array(shard_of(shards))).withColumn(
        "floor", F.lit(None).cast("double")
    )
    first = stored(
        scatter(candidates, home, shards).mapInArrow(lambda b: _searched(b, k), SCHEMA),
        "ball_tree_first",
    )
    if shards == 1:
        return best(first, k, largest=True)
    floors = first.groupBy("query_row").agg(
        F.count("*").alias("n"), F.min("score").cast("double").alias("least")
    ).select(
        F.col("query_row").alias("row"),
        F.when(F.col("n") >= k, F.col("least")).alias("floor"),
    )
    others = F.array_remove(F.sequence(F.lit(0), F.lit(shards - 1)), shard_of(shards))
    rest = queries.join(floors, "row", "left").withColumn("targets", others)
    second = scatter(candidates, rest, shards).mapInArrow(lambda b: _searched(b, k), SCHEMA)
    return best(first.unionByName(second), k, largest=True)


def search(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 64,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Top k of ``vectors`` for the rows whose id is divisible by ``every``, against all rows.

    ``vectors`` is read once and written with its row numbers.  Vectors that are null or hold a null or non-finite component, and rows without an id, take no part.  Repeated rows
    are candidates of each other.  No rows give no rows.  Other columns are ignored.  Components
    and scores must fit a long; others are an error.
    """
    taking_part = as_integers(clean(vectors, id_col, vector_col), scale)
    queries = taking_part.filter(F.col("vec_id") % every == 0)
    return top_k(taking_part, queries, k, shard_rows)
