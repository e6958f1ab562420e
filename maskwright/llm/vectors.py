"""Vectors in shards: what the exact and the approximate search have in common.

Candidates are dealt to shards by a hash of their row number; queries go to every shard that can
hold candidates of theirs.  Within a task the rows of a shard come sorted, candidates first, so
the task builds one index and then streams the queries past it in blocks: its memory is bounded
by a shard and a block, however many queries there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskwright.llm.common import column, small_batches, stored

# Queries searched together within a task.
BLOCK = 512
RESULT_SCHEMA = (
    "query_row bigint, query_id bigint, row bigint, vec_id bigint, score {}"
)


class Rows(NamedTuple):
    """Rows of one kind (candidates or queries) of a shard."""

    row: np.ndarray
    vec_id: np.ndarray
    floor: np.ndarray
    vectors: np.ndarray


def clean(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(row, vec_id, vector) of the rows that take part: an id, and a vector of finite numbers.

    Written once, so that every pass reads the same row numbers.
    """
    vector = column(vector_col)
    whole = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))),
    )
    kept = df.select(
        F.monotonically_increasing_id().alias("row"),
        column(id_col).cast("bigint").alias("vec_id"),
        vector.alias("vector"),
    ).filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & whole)
    return stored(kept, "vector_rows")


def shard_of(shards: int) -> Column:
    return F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")


def scatter(candidates: DataFrame, queries: DataFrame, shards: int) -> DataFrame:
    """Rows (dim, shard, is_query, row, vec_id, floor, vector), sorted within each shard.

    ``queries`` brings an array ``targets`` of shards and the score ``floor`` known so far.
    """
    small_batches(candidates.sparkSession)
    dim = F.size("vector").alias("dim")
    nothing = F.lit(None).cast("double").alias("floor")
    both = candidates.select(
        dim, shard_of(shards).alias("shard"), F.lit(False).alias("is_query"), "row", "vec_id",
        nothing, "vector",
    ).unionByName(queries.select(
        dim, F.explode("targets").alias("shard"), F.lit(True).alias("is_query"), "row", "vec_id",
        "floor", "vector",
    ))
    return both.repartition("dim", "shard").sortWithinPartitions(
        "dim", "shard", "is_query", "row"
    )


def _rows_of(batch: pa.RecordBatch, dim: int) -> Rows:
    vectors = batch.column(6)
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    return Rows(
        batch.column(3).to_numpy(), batch.column(4).to_numpy(),
        batch.column(5).to_numpy(zero_copy_only=False), values.reshape(len(batch), dim),
    )


def _joined(parts: list[Rows]) -> Rows:
    return parts[0] if len(parts) == 1 else Rows(*map(np.concatenate, zip(*parts)))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, Rows]]:
    """((dim, shard), is_query, rows): stretches of rows of one shard and kind."""
    for batch in batches:
        if not len(batch):
            continue
        dims, shards, kinds = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        changes = 1 + np.flatnonzero(
            (dims[1:] != dims[:-1]) | (shards[1:] != shards[:-1]) | (kinds[1:] != kinds[:-1])
        )
        for a, b in zip([0, *changes], [*changes, len(batch)], strict=True):
            rows = _rows_of(batch.slice(a, b - a), int(dims[a]))
            yield (dims[a], shards[a]), bool(kinds[a]), rows


def search_shards(
    batches: Iterator[pa.RecordBatch],
    index: Callable[[Rows], Any],
    search: Callable[[Any, Rows], pa.RecordBatch],
    block: int = BLOCK,
) -> Iterator[pa.RecordBatch]:
    """Build the index of each shard once and search it with every block of its queries."""
    for _, parts in groupby(_segments(batches), key=lambda part: part[0]):
        held: list[Rows] = []
        built = None
        for _, is_query, rows in parts:
            if not is_query:
                held.append(rows)
                continue
            if held:
                built, held = index(_joined(held)), []
            if built is not None:
                for i in range(0, len(rows.row), block):
                    yield search(built, Rows(*(x[i:i + block] for x in rows)))


def best(found: DataFrame, k: int, largest: bool) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every query, ties to the smaller id."""
    score = F.col("score").desc() if largest else F.col("score").asc()
    order = Window.partitionBy("query_row").orderBy(score, "vec_id", "row")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def results(
    queries: Rows, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, real: np.ndarray
) -> pa.RecordBatch:
    """The found entries (queries x k arrays, ``real`` where filled) as one batch."""
    q, _ = np.nonzero(real)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(queries.row[q]), pa.array(queries.vec_id[q]), pa.array(rows[real]),
            pa.array(ids[real]), pa.array(scores[real]),
        ],
        names=["query_row", "query_id", "row", "vec_id", "score"],
    )
