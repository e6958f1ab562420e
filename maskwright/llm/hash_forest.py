"""Approximate nearest neighbours with a forest of hash prefixes.

Every tree has its own random hyperplanes.  A vector's hash string has one bit per plane: the
side on which it lies.  A tree is the sorted array of its hash strings.  A query descends in
every tree to the rows with the longest common prefix, and then ascends in all trees at once: at
each step the prefix is one bit shorter, and the rows of all trees that share it become
candidates, until there are enough.  Candidates are ranked by their exact distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.llm.vectors import (
    RESULT_SCHEMA, Rows, best, clean, results, scatter, search_shards,
)

TREES = 32
BITS = 64
SEED = 7
# The ascent ends when this share of a shard, and at least so many times k rows, are candidates.
SHARE = 0.5
LEAST = 20
SHARD_ROWS = 8192
SCHEMA = RESULT_SCHEMA.format("double")


class Forest:
    """The trees of one shard.  A plane passes through the middle of the shard's rows: the bit
    says whether a vector's projection exceeds the median."""

    def __init__(self, rows: Rows, trees: int, bits: int, seed: int) -> None:
        self.rows = rows
        self.points = rows.vectors.astype(np.float64)
        self.bits = bits
        dim = self.points.shape[1]
        self.planes, self.middles, self.strings, self.orders = [], [], [], []
        for tree in range(trees):
            planes = np.random.default_rng((seed, tree, dim)).standard_normal((dim, bits))
            sides = self.points @ planes
            middle = np.median(sides, axis=0)
            strings = self._strings(sides, middle)
            order = np.argsort(strings, kind="stable")
            self.planes.append(planes)
            self.middles.append(middle)
            self.strings.append(strings[order])
            self.orders.append(order)

    def _strings(self, sides: np.ndarray, middle: np.ndarray) -> np.ndarray:
        """Bits as unsigned numbers, the first bit highest, so that numbers sort as strings."""
        weights = np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64)
        return ((sides > middle).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)

    def candidates(self, queries: np.ndarray, enough: int) -> Iterator[np.ndarray]:
        """For each query the rows whose prefixes match, from the longest on, until enough."""
        bits, n = self.bits, len(self.points)
        strings = [
            self._strings(queries @ planes, middle)
            for planes, middle in zip(self.planes, self.middles, strict=True)
        ]
        # Ranges of rows that share a prefix of each length, per tree: lengths x trees x queries.
        begins = np.empty((bits + 1, len(strings), len(queries)), dtype=np.int64)
        ends = np.empty_like(begins)
        for tree, (mine, sorted_) in enumerate(zip(strings, self.strings, strict=True)):
            begins[0, tree], ends[0, tree] = 0, n
            for length in range(1, bits + 1):
                rest = np.uint64(bits - length)
                low = (mine >> rest) << rest
                high = low | ((np.uint64(1) << rest) - np.uint64(1))
                begins[length, tree] = np.searchsorted(sorted_, low, side="left")
                ends[length, tree] = np.searchsorted(sorted_, high, side="right")
        found = (ends - begins).sum(axis=1)
        for q in range(len(queries)):
            # No fewer than ``enough`` rows can come from a shorter prefix than this.
            length = int(np.flatnonzero(found[:, q] >= min(enough, n))[-1])
            seen = np.zeros(n, dtype=bool)
            while True:
                for tree, order in enumerate(self.orders):
                    seen[order[begins[length, tree, q]:ends[length, tree, q]]] = True
                if length == 0 or int(seen.sum()) >= enough:
                    break
                length -= 1
            yield np.flatnonzero(seen)


def _searched(
    batches: Iterator[pa.RecordBatch], k: int, trees: int, bits: int, seed: int, share: float
) -> Iterator[pa.RecordBatch]:
    def index(rows: Rows) -> Forest:
        return Forest(rows, trees, bits, seed)

    def search(forest: Forest, queries: Rows) -> pa.RecordBatch:
        n, own = len(queries.row), forest.rows
        rows = np.full((n, k), -1)
        ids = np.zeros((n, k), dtype=np.int64)
        scores = np.zeros((n, k))
        points = queries.vectors.astype(np.float64)
        # The query's own row may be among the candidates.
        enough = max(LEAST * k, int(np.ceil(share * len(own.row)))) + 1
        for q, near in enumerate(forest.candidates(points, enough)):
            near = near[own.row[near] != queries.row[q]]
            gaps = forest.points[near] - points[q]
            distances = np.sqrt((gaps * gaps).sum(axis=1))
            order = np.lexsort((own.vec_id[near], distances))[:k]
            m = len(order)
            rows[q, :m] = own.row[near[order]]
            ids[q, :m] = own.vec_id[near[order]]
            scores[q, :m] = distances[order]
        return results(queries, rows, ids, scores, rows >= 0)

    return search_shards(batches, index, search)


def search(
    vectors: DataFrame,
    k: int = 10,
    every: int = 100,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    trees: int = TREES,
    bits: int = BITS,
    seed: int = SEED,
    share: float = SHARE,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): near rows of those whose id is divisible by ``every``.

    Every row is indexed, in the forest of its shard, and every query searches all shards; the
    score is the Euclidean distance in doubles.  ``share`` trades recall for work (the rows of
    one cluster of high dimension are nearly equally far, so half of a shard is the default).
    Rows equal to the query share all its prefixes and are always found.  Ties go to the smaller
    id; with fewer than k candidates all are returned.

    Vectors that are null, zero, or hold a null or non-finite component, and rows without an id,
    take no part; vectors meet only those of equal length.  Repeated rows are candidates of each
    other.  No rows give no rows.  Other columns are ignored.  ``vectors`` is read once and
    written with its row numbers.
    """
    if not 1 <= bits <= 64:
        raise ValueError("bits must be from 1 to 64")
    taking_part = clean(vectors, id_col, vector_col).filter(F.exists("vector", lambda x: x != 0))
    queries = taking_part.filter(F.col("vec_id") % every == 0)
    shards = max(1, -(-taking_part.count() // shard_rows))
    targets = queries.withColumn("targets", F.sequence(F.lit(0), F.lit(shards - 1))).withColumn(
        "floor", F.lit(None).cast("double")
    )
    found = scatter(taking_part, targets, shards).mapInArrow(
        lambda batches: _searched(batches, k, trees, bits, seed, share), SCHEMA
    )
    return best(found, k, largest=False)
