"""Hard-negative mining with bounds along a spanning tree of the anchors.

The inner products of a candidate c with two anchors differ by at most |a - b| |c|.  So the score
known at an anchor's parent, plus or minus the length of the edge times the candidate's norm,
bounds the score at the anchor.  Near anchors share a block, a block's anchors are joined by a
minimum spanning tree, and the tree is walked from its root: a candidate is scored again only if
its bounds overlap what the anchor looks for.  Otherwise its bounds grow by the next edge.

Two walks: the first finds the positives (the best rows of the anchor's label), the second the
negatives, rows of other labels whose score lies in the window that a positive's score opens.

Every block meets every shard of candidates, as every anchor has to be held against all rows: the
work grows with anchors times rows.  A block is shuffled to a shard once, in a few hundred
kilobytes, and then stands for some hundred million multiplications.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskwright.llm.common import column, release_memory, small_batches, stored

# Rows of a shard of candidates, about, and anchors of a tree, at most (a power of two).
SHARD_ROWS = 16_384
BLOCK_ANCHORS = 256
# Random directions whose signs put near anchors into one block.
DIRECTIONS = 16
SEED = 20_251
HIT = "struct<row:bigint,vec_id:bigint,score:bigint>"
TREE_SCHEMA = (
    "dim int, block bigint, rows array<bigint>, ids array<bigint>, labels array<string>, "
    "vectors binary, parents array<int>, edges array<double>"
)
POSITIVE_SCHEMA = "anchor_row bigint, row bigint, vec_id bigint, score bigint"
NEGATIVE_SCHEMA = (
    "anchor_row bigint, anchor_id bigint, positive_row bigint, positive_id bigint, "
    "positive_score bigint, row bigint, vec_id bigint, score bigint"
)


class Tree(NamedTuple):
    """Anchors in the order of the walk; the parent of each comes before it (-1: the root)."""

    rows: list[int]
    ids: list[int]
    labels: list[str]
    vectors: np.ndarray
    parents: list[int]
    edges: list[float]
    # Per anchor, its positives (row, vec_id, score); empty in the first walk.
    positives: dict[int, list[dict]]


def spanning_tree(points: np.ndarray) -> tuple[list[int], list[int]]:
    """The order of a walk over a minimum spanning tree, and each one's parent in that order.

    Parents come before their children, and of a node's children the one with most nodes below
    it comes last, so that a walk remembers few nodes at a time.
    """
    n = len(points)
    norms = (points * points).sum(axis=1)
    parent = np.zeros(n, dtype=np.int64)
    least = np.full(n, np.inf)
    inside = np.zeros(n, dtype=bool)
    picked, now = [0], 0
    inside[0] = True
    for _ in range(n - 1):
        far = norms + norms[now] - 2 * (points @ points[now])
        closer = ~inside & (far < least)
        least[closer], parent[closer] = far[closer], now
        now = int(np.where(inside, np.inf, least).argmin())
        inside[now] = True
        picked.append(now)
    below = np.ones(n, dtype=np.int64)
    children: list[list[int]] = [[] for _ in range(n)]
    for node in reversed(picked[1:]):
        below[parent[node]] += below[node]
        children[parent[node]].append(node)
    order, parents, stack = [], [], [(0, -1)]
    while stack:
        node, above = stack.pop()
        order.append(node)
        parents.append(above)
        # The last one pushed is walked first.
        for child in sorted(children[node], key=lambda c: -below[c]):
            stack.append((child, len(order) - 1))
    return order, parents


class Shard:
    """Candidates in memory: whole-number vectors, their norms and labels."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray,
                 vectors: np.ndarray) -> None:
        self.rows, self.ids = rows, ids
        self.names, self.labels = np.unique(labels.astype(object), return_inverse=True)
        self.exact, self.points = vectors, vectors.astype(np.float64)
        # Rounding is on the safe side.
        self.norms = np.linalg.norm(self.points, axis=1) * (1 + 1e-9) + 1e-9
        self.largest = float(np.abs(self.points).max(initial=0))

    def label(self, name: str) -> int:
        """The number of a label; -1 if no candidate has it."""
        at = int(np.searchsorted(self.names, name))
        return at if at < len(self.names) and self.names[at] == name else -1

    def scores(self, vector: np.ndarray, at: np.ndarray | slice) -> np.ndarray:
        """The exact inner products of some candidates."""
        reach = self.largest * float(np.abs(vector).max(initial=0)) * max(1, len(vector))
        if reach < 2.0**52:
            return np.rint(self.points[at] @ vector.astype(np.float64)).astype(np.int64)
        return (self.exact[at].astype(object) @ vector.astype(object)).astype(np.int64)


class Walk:
    """A walk over a tree: bounds of all candidates' scores, carried from parent to child."""

    def __init__(self, shard: Shard, tree: Tree) -> None:
        self.shard, self.tree = shard, tree
        self.last_child = {parent: i for i, parent in enumerate(tree.parents)}
        # Scores computed, of anchors times candidates.
        self.scored = 0

    def run(self, wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray],
            take: Callable[[int, np.ndarray, np.ndarray], None]) -> None:
        """``wanted(anchor, low, high)`` names the candidates to be scored (their places), and
        ``take(anchor, places, scores)`` gets their scores."""
        shard, tree = self.shard, self.tree
        n = len(shard.rows)
        states: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for i, parent in enumerate(tree.parents):
            if parent < 0:
                # Nothing is known at the root: all are scored.
                middle, reach = np.zeros(n), np.full(n, np.inf)
            else:
                middle, reach = states[parent]
                if self.last_child[parent] == i:
                    del states[parent]
                else:
                    middle, reach = middle.copy(), reach.copy()
                reach += tree.edges[i] * shard.norms
            vector = tree.vectors[i]
            places = wanted(i, middle - reach, middle + reach)
            if parent < 0 or 2 * len(places) > n:
                # One product over the whole shard costs less than to pick most of it.
                scores = shard.scores(vector, slice(None))
                self.scored += n
                middle[:], reach[:] = scores, 0
                take(i, places, scores[places])
            elif len(places):
                scores = shard.scores(vector, places)
                self.scored += len(places)
                middle[places], reach[places] = scores, 0
                take(i, places, scores)
            if i in self.last_child:
                states[i] = middle, reach


def _kth(values: np.ndarray, k: int) -> float:
    """The k-th largest value; minus infinity if there are fewer."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def _best(shard: Shard, places: np.ndarray, scores: np.ndarray, k: int) -> list[tuple]:
    """(row, vec_id, score) of the k largest scores, ties to the smaller id."""
    if len(places) > 4 * k:
        high = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        places, scores = places[high], scores[high]
    order = np.lexsort((shard.rows[places], shard.ids[places], -scores))[:k]
    return [
        (int(shard.rows[p]), int(shard.ids[p]), int(s))
        for p, s in zip(places[order], scores[order], strict=True)
    ]


def positives(shard: Shard, tree: Tree, k: int) -> tuple[list[tuple], Walk]:
    """(anchor row, row, id, score): the k best other candidates of every anchor's label."""
    found: list[tuple] = []
    walk = Walk(shard, tree)
    labels = [shard.label(name) for name in tree.labels]
    members = {label: np.flatnonzero(shard.labels == label) for label in set(labels)}

    def wanted(i: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        same = members[labels[i]]
        same = same[shard.rows[same] != tree.rows[i]]
        # k of them reach this score at least, so others with less are not among the best.
        return same[high[same] >= _kth(low[same], k)]

    def take(i: int, places: np.ndarray, scores: np.ndarray) -> None:
        found.extend((tree.rows[i], *hit) for hit in _best(shard, places, scores, k))

    walk.run(wanted, take)
    return found, walk


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The whole numbers between ``low`` and ``high`` percent of a score."""
    return -(-low * score // 100), high * score // 100


def negatives(shard: Shard, tree: Tree, k: int, low: int, high: int) -> tuple[list[tuple], Walk]:
    """For every anchor and positive, the k best candidates of other labels in its window."""
    found: list[tuple] = []
    walk = Walk(shard, tree)
    labels = [shard.label(name) for name in tree.labels]
    looked = [
        [(hit, *window(hit["score"], low, high)) for hit in tree.positives.get(row, [])]
        for row in tree.rows
    ]

    def wanted(i: int, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        out = np.zeros(len(least), dtype=bool)
        other = shard.labels != labels[i]
        for _, begin, end in looked[i]:
            overlaps = other & (most >= begin) & (least <= end)
            # If k lie in the window for certain, others with less are not among the best.
            sure = least[overlaps & (least >= begin) & (most <= end)]
            out |= overlaps & (most >= _kth(sure, k))
        return np.flatnonzero(out)

    def take(i: int, places: np.ndarray, scores: np.ndarray) -> None:
        for hit, begin, end in looked[i]:
            inside = (scores >= begin) & (scores <= end)
            found.extend(
                (tree.rows[i], tree.ids[i], hit["row"], hit["vec_id"], hit["score"], *best)
                for best in _best(shard, places[inside], scores[inside], k)
            )

    walk.run(wanted, take)
    return found, walk


def _codes(batches: Iterator[pa.RecordBatch], directions: int) -> Iterator[pa.RecordBatch]:
    """Rows with the signs of their products with random directions as the bits of ``code``."""
    known: dict[int, np.ndarray] = {}
    for batch in batches:
        codes = []
        for vector in batch.column(batch.schema.get_field_index("vector")):
            x = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if len(x) not in known:
                random = np.random.default_rng((SEED, len(x)))
                known[len(x)] = random.standard_normal((directions, len(x)))
            bits = known[len(x)] @ x > 0
            codes.append(int(bits @ (1 << np.arange(directions))))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(codes, pa.int64())], names=[*batch.schema.names, "code"]
        )


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted anchors (dim, block, row, vec_id, label, vector) as one tree per (dim, block)."""
    key, held = None, []

    def tree() -> pa.RecordBatch:
        exact = np.array([v for *_, v in held], dtype=np.int64).reshape(len(held), key[0])
        points = exact.astype(np.float64)
        order, parents = spanning_tree(points)
        edges = [
            float(np.linalg.norm(points[node] - points[order[p]])) * (1 + 1e-9) + 1e-9 if p >= 0 else 0.0
            for node, p in zip(order, parents, strict=True)
        ]
        rows, ids, labels = ([held[i][c] for i in order] for c in range(3))
        return pa.RecordBatch.from_pylist([{
            "dim": key[0], "block": key[1], "rows": rows, "ids": ids, "labels": labels,
            "vectors": exact[order].tobytes(), "parents": parents, "edges": edges,
        }], schema=pa.schema([
            ("dim", pa.int32()), ("block", pa.int64()), ("rows", pa.list_(pa.int64())),
            ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.string())),
            ("vectors", pa.binary()), ("parents", pa.list_(pa.int32())),
            ("edges", pa.list_(pa.float64())),
        ]))

    for batch in batches:
        for dim, block, *anchor in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key is not None and key != (dim, block):
                yield tree()
                held = []
            key = dim, block
            held.append(anchor)
    if key is not None:
        yield tree()


def anchor_trees(anchors: DataFrame, block: int = BLOCK_ANCHORS) -> DataFrame:
    """One row per block of near anchors, with their spanning tree.

    Anchors (row, vec_id, label, vector) are sorted, over ranges, by the signs of their products
    with random directions, and cut into blocks of ``block``; the cuts change the work only.
    """
    schema = anchors.schema.simpleString()[len("struct<"):-1]
    tasks = max(1, -(-anchors.count() // (16 * block)))
    coded = stored(
        anchors.mapInArrow(lambda b: _codes(b, DIRECTIONS), f"{schema},code:bigint"), "anchor_codes"
    ).withColumn("dim", F.size("vector"))
    # The number of a sorted row: its task's, then its place there.
    placed = coded.repartitionByRange(tasks, "dim", "code", "row").sortWithinPartitions(
        "dim", "code", "row"
    ).select(
        "dim", F.floor(F.monotonically_increasing_id() / block).alias("block"), "row", "vec_id",
        "label", "vector",
    )
    sorted_rows = stored(placed, "anchor_blocks").repartition("dim", "block").sortWithinPartitions(
        "dim", "block", "row"
    )
    return stored(sorted_rows.mapInArrow(_trees, TREE_SCHEMA), "anchor_trees")


def _shard_of(shards: int) -> Column:
    return F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")


def _meet(candidates: DataFrame, trees: DataFrame, shards: int) -> DataFrame:
    """All rows of a shard, followed by all trees of vectors of their length."""
    tree = F.struct("rows", "ids", "labels", "vectors", "parents", "edges", "positives")
    kind = trees.select(tree.alias("tree")).schema["tree"].dataType
    rows = candidates.select(
        F.size("vector").alias("dim"), _shard_of(shards).alias("shard"), F.lit(0).alias("kind"),
        "row", "vec_id", "label", "vector", F.lit(None).cast(kind).alias("tree"),
    )
    vector = candidates.schema["vector"].dataType
    blocks = trees.select(
        "dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.lit(1).alias("kind"), F.col("block").alias("row"), F.lit(None).cast("bigint").alias("vec_id"),
        F.lit(None).cast("string").alias("label"), F.lit(None).cast(vector).alias("vector"),
        tree.alias("tree"),
    )
    return rows.unionByName(blocks).repartition("dim", "shard").sortWithinPartitions(
        "dim", "shard", "kind", "row"
    )


def _tree_of(value: dict, dim: int) -> Tree:
    vectors = np.frombuffer(value["vectors"], dtype=np.int64).reshape(len(value["rows"]), dim)
    known = {one["anchor_row"]: one["hits"] for one in value["positives"] or []}
    return Tree(value["rows"], value["ids"], value["labels"], vectors, value["parents"],
                value["edges"], known)


def _searched(
    batches: Iterator[pa.RecordBatch], search: Callable[[Shard, Tree], list[tuple]], names: list[str]
) -> Iterator[pa.RecordBatch]:
    """Hold one shard at a time and search it with every tree that follows it."""
    key: Any = None
    held: list[tuple] = []
    shard: Shard | None = None
    for batch in batches:
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        kinds = batch.column(2).to_numpy()
        cuts = [i for i in range(1, len(batch)) if keys[i] != keys[i - 1] or kinds[i] != kinds[i - 1]]
        for a, b in zip([0, *cuts], [*cuts, len(batch)], strict=True):
            if a == b:
                continue
            if keys[a] != key:
                key, held, shard = keys[a], [], None
            part = batch.slice(a, b - a)
            if not kinds[a]:
                vectors = part.column(6).flatten().to_numpy(zero_copy_only=False)
                held.append((
                    part.column(3).to_numpy(), part.column(4).to_numpy(),
                    part.column(5).to_numpy(zero_copy_only=False),
                    vectors.reshape(b - a, key[0]),
                ))
                continue
            if held:
                shard, held = Shard(*(np.concatenate(c) for c in zip(*held, strict=True))), []
            if shard is None:
                continue
            for value in part.column(7):
                found = search(shard, _tree_of(value.as_py(), key[0]))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=names
                    )
    release_memory()


def taking_part(
    vectors: DataFrame, label: Column, id_col: str, vector_col: str, scale: int
) -> DataFrame:
    """(row, vec_id, label, vector) of the rows with an id, a label and a vector of finite numbers,
    each component x as floor(scale * x); written once with the row numbers."""
    parts = column(vector_col)
    whole = F.forall(
        parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    integers = F.transform(parts, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    kept = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        column(id_col).cast("bigint").alias("vec_id"),
        label.cast("string").alias("label"),
        F.when(whole, integers).alias("vector"),
    ).filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    return stored(kept, "anchor_rows")


def mine(
    vectors: DataFrame,
    label: Column | None = None,
    every: int = 50,
    n_positives: int = 5,
    n_negatives: int = 3,
    low: int = 50,
    high: int = 95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    shard_rows: int = SHARD_ROWS,
    block: int = BLOCK_ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``.  Their positives are the
    ``n_positives`` best other rows of the same ``label`` (default: column ``label``); for each
    of them the ``n_negatives`` best rows of other labels whose score is between ``low`` and
    ``high`` percent of the positive's, all if there are fewer.  Scores are exact inner products
    of whole numbers, ties go to the smaller id, then to the earlier row.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part.
    Repeated rows are rows of their own.  Vectors meet only those of equal length.  A positive of
    negative score opens no window.  No rows give no rows.  Other columns are ignored.  Components
    and scores must fit a long.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = taking_part(
        vectors, label if label is not None else column("label"), id_col, vector_col, scale
    )
    shards = max(1, -(-rows.count() // shard_rows))
    trees = anchor_trees(rows.filter(F.col("vec_id") % every == 0), block)
    nothing = F.lit(None).cast(f"array<struct<anchor_row:bigint,hits:array<{HIT}>>>")

    names = [c.split()[0] for c in POSITIVE_SCHEMA.split(", ")]
    first = _meet(rows, trees.withColumn("positives", nothing), shards).mapInArrow(
        lambda b: _searched(b, lambda s, t: positives(s, t, n_positives)[0], names), POSITIVE_SCHEMA
    )
    best_first = Window.partitionBy("anchor_row").orderBy(F.desc("score"), "vec_id", "row")
    hits = (
        first.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= n_positives)
        .groupBy("anchor_row").agg(F.collect_list(F.struct("row", "vec_id", "score")).alias("hits"))
    )
    # As many entries as a block has anchors, each with a few positives.
    placed = trees.select("dim", "block", F.explode("rows").alias("anchor_row"))
    told = placed.join(hits, "anchor_row").groupBy("dim", "block").agg(
        F.collect_list(F.struct("anchor_row", "hits")).alias("positives")
    )
    ready = stored(trees.join(told, ["dim", "block"]), "anchor_windows")

    names_2 = [c.split()[0] for c in NEGATIVE_SCHEMA.split(", ")]
    second = _meet(rows, ready, shards).mapInArrow(
        lambda b: _searched(
            b, lambda s, t: negatives(s, t, n_negatives, low, high)[0], names_2), NEGATIVE_SCHEMA
    )
    of_positive = Window.partitionBy("anchor_row", "positive_row").orderBy(
        F.desc("score"), "vec_id", "row"
    )
    return (
        second.withColumn("rank", F.row_number().over(of_positive))
        .filter(F.col("rank") <= n_negatives)
        .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                "positive_score", F.col("score").alias("negative_score"))
    )
