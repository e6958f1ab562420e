"""Merkle manifest of a dataset: proofs by butterfly exchange.

Rows are leaves, in trees of fan-out ``FANOUT``: one tree per group, and one over the groups'
roots.  The leaves of a tree are dealt, in order, to aligned partitions of FANOUT ** HEIGHT leaves.
A partition hashes its own subtree.  Then, round by round, aligned runs of FANOUT subtrees swap
their roots: a partition sends the root it holds to one partition of every sibling subtree, gets
theirs, and hashes the common ancestor itself, as all others of the run do.  The roots it got are
the upper siblings of all its leaves, so after the last round it holds their whole proofs and no
pass leads down again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.llm.common import column, release_memory, small_batches, stored

FANOUT = 16
HEIGHT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 32
PROOF = "array<struct<position:int,siblings:binary>>"
_PROOF = pa.list_(pa.struct([("position", pa.int32()), ("siblings", pa.binary())]))


def hashed(text: Column) -> Column:
    """The SHA-256 of a text, as bytes."""
    return F.unhex(F.sha2(text, 256))


def as_hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row: every value as its byte count, a colon and itself; ``-`` if null."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return hashed(F.concat(*map(part, values)))


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    def up(node: Column, level: Column) -> Column:
        before = level["position"] * DIGEST
        siblings = level["siblings"]
        return hashed(F.concat(
            as_hex(F.substring(siblings, F.lit(1), before)), as_hex(node),
            as_hex(F.substring(siblings, before + 1, F.octet_length(siblings))),
        ))

    return F.aggregate(proof, start, up)


def proof_text(proof: Column) -> Column:
    """All siblings of a proof in hexadecimal, from the leaf's level to the root's."""
    return F.array_join(F.transform(proof, lambda level: as_hex(level["siblings"])), "")


def _parents(nodes: list[bytes], fanout: int) -> list[bytes]:
    out = []
    for i in range(0, len(nodes), fanout):
        out.append(hashlib.sha256(b"".join(nodes[i:i + fanout]).hex().encode()).digest())
    return out


def _levels(leaves: list[bytes], fanout: int, height: int, sole: bool) -> list[list[bytes]]:
    """The levels of a partition's subtree, leaves first: ``height`` above the leaves, or in the
    only partition of a tree as many as lead to one node."""
    levels = [leaves]
    while len(levels[-1]) > 1 if sole else len(levels) <= height:
        levels.append(_parents(levels[-1], fanout))
    return levels


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with the number of their task and their place among its rows of one tree."""
    from pyspark import TaskContext

    task = TaskContext.get().partitionId()
    last, seen = None, 0
    for batch in batches:
        if not len(batch):
            continue
        places, at = [], 0
        runs = pc.run_end_encode(batch.column(0))
        for end, tree in zip(runs.run_ends.to_pylist(), runs.values.to_pylist(), strict=True):
            if tree != last:
                last, seen = tree, 0
            places.extend(range(seen, seen + end - at))
            seen += end - at
            at = end
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([task] * len(batch), pa.int32()), pa.array(places, pa.int64())],
            names=[*batch.schema.names, "task", "place"],
        )


def _in_order(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """(tree, ordinal, leaf, payload) of rows (tree, leaf, payload, ...): the place of every leaf
    in its tree, by a range sort, however many rows a tree has.

    Only the first tree of a task can have begun in an earlier one, so the offsets that are
    broadcast are one row per task at most.
    """
    ranged = leaves.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    rows = ranged.select("tree", "leaf", "payload")
    schema = T.StructType([
        *rows.schema.fields, T.StructField("task", T.IntegerType()),
        T.StructField("place", T.LongType()),
    ])
    placed = stored(rows.mapInArrow(_positions, schema), "merkle_sorted")
    before = Window.partitionBy("tree").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        placed.groupBy("tree", "task").agg(F.count("*").alias("n"))
        .select("tree", "task", F.sum("n").over(before).alias("offset"))
        .filter("offset > 0")
    )
    return placed.join(F.broadcast(offsets), ["tree", "task"], "left").select(
        "tree", (F.col("place") + F.coalesce("offset", F.lit(0))).alias("ordinal"), "leaf", "payload"
    )


def _subtrees(
    batches: Iterator[pa.RecordBatch], fanout: int, height: int
) -> Iterator[pa.RecordBatch]:
    """Sorted rows (tree, part, leaf, payload) as one row per partition of the tree, with the root
    that it has in a larger tree, and the one that it has alone."""
    key, leaves, payloads = None, [], []

    def row() -> pa.RecordBatch:
        values = pa.concat_arrays(payloads)
        sole = _levels(leaves, fanout, height, True)[-1][0]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([key[0]], pa.string()), pa.array([key[1]], pa.int64()),
                pa.array([b"".join(leaves)], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values),
                pa.array([_levels(leaves, fanout, height, False)[-1][0]], pa.binary()),
                pa.array([sole], pa.binary()),
            ],
            names=["tree", "part", "leaves", "payloads", "root", "sole"],
        )

    for batch in batches:
        trees, parts, digests = (batch.column(i).to_pylist() for i in range(3))
        at = 0
        while at < len(batch):
            now, end = (trees[at], parts[at]), at
            while end < len(batch) and (trees[end], parts[end]) == now:
                end += 1
            if key is not None and now != key:
                yield row()
                leaves, payloads = [], []
            key = now
            leaves.extend(digests[at:end])
            payloads.append(batch.column(3).slice(at, end - at))
            at = end
    if key is not None:
        yield row()
    release_memory()


def _exchange(states: DataFrame, subtree: int, fanout: int) -> DataFrame:
    """One round: subtrees of ``subtree`` partitions swap their roots in runs of ``fanout``.

    ``states`` are rows (tree, part, parts, node, proof); trees that are down to one node stay as
    they are.  The last subtree of a tree can have fewer partitions than its siblings have; each
    of them then sends its root to several.  A partition gets at most ``fanout`` roots.
    """
    nodes = F.ceil(F.col("parts") / subtree)
    going = states.filter(nodes > 1)
    own, place = F.floor(F.col("part") / subtree), F.col("part") % subtree
    first = own - own % fanout
    last = F.least(first + fanout - 1, nodes - 1)

    def width(node: Column) -> Column:
        return F.least(F.lit(subtree).cast("bigint"), F.col("parts") - node * subtree)

    def targets(node: Column) -> Column:
        """The partitions of a subtree that this one sends to."""
        reached = F.sequence(place, F.greatest(place, width(node) - 1), width(own))
        there = F.filter(reached, lambda p: p < width(node))
        return F.when(node == own, F.array("part")).otherwise(
            F.transform(there, lambda p: node * subtree + p)
        )

    mine = F.col("to") == F.col("part")
    sent = going.select(
        "tree", "part", "parts", "node", "proof", (own % fanout).cast("int").alias("place"),
        F.explode(F.flatten(F.transform(F.sequence(first, last), targets))).alias("to"),
    )
    got = sent.groupBy("tree", "to").agg(
        F.array_sort(F.collect_list(F.struct("place", "node"))).alias("nodes"),
        F.max("parts").alias("parts"),
        F.max(F.when(mine, F.col("place"))).alias("own"),
        F.max(F.when(mine, F.col("proof"))).alias("proof"),
    )

    def joined(nodes: Column) -> Column:
        return F.aggregate(nodes, F.lit(b""), lambda a, n: F.concat(a, n["node"]))

    siblings = F.filter("nodes", lambda n: n["place"] != F.col("own"))
    level = F.struct(F.col("own").alias("position"), joined(siblings).alias("siblings"))
    return got.select(
        "tree", F.col("to").alias("part"), "parts", hashed(as_hex(joined(F.col("nodes")))).alias("node"),
        F.array_append("proof", level).cast(PROOF).alias("proof"),
    ).unionByName(states.filter(nodes <= 1))


def _butterfly(parts: DataFrame, fanout: int) -> DataFrame:
    """(tree, part, parts, node, proof): the root of every partition's tree and the siblings above
    the partition, after as many rounds as the largest tree needs (the driver sees one number)."""
    counted = parts.groupBy("tree").agg(F.count("*").alias("parts"))
    states = stored(
        parts.join(counted, "tree").select(
            "tree", "part", "parts",
            F.when(F.col("parts") > 1, F.col("root")).otherwise(F.col("sole")).alias("node"),
            F.array().cast(PROOF).alias("proof"),
        ),
        "merkle_states",
    )
    most, subtree = states.agg(F.max("parts")).first()[0] or 0, 1
    while subtree < most:
        states = _exchange(states, subtree, fanout)
        subtree *= fanout
    return stored(states, "merkle_roots")


def _proved(batches: Iterator[pa.RecordBatch], fanout: int, height: int) -> Iterator[pa.RecordBatch]:
    """Rows (leaves, payloads, parts, upper, about) as one row per leaf, with its proof."""
    for batch in batches:
        for i in range(len(batch)):
            blob = batch.column(0)[i].as_py()
            own = [blob[k:k + DIGEST] for k in range(0, len(blob), DIGEST)]
            levels = _levels(own, fanout, height, batch.column(2)[i].as_py() == 1)[:-1]
            upper = batch.column(3)[i].as_py()
            payloads = batch.column(1)[i].values
            # A slice of leaves at a time: proofs are far larger than leaves.
            for k in range(0, len(own), 512):
                proofs = []
                for at in range(k, min(k + 512, len(own))):
                    proof, node = [], at
                    for level in levels:
                        begin = node - node % fanout
                        siblings = level[begin:node] + level[node + 1:begin + fanout]
                        proof.append({"position": node % fanout, "siblings": b"".join(siblings)})
                        node //= fanout
                    proofs.append(proof + upper)
                yield pa.RecordBatch.from_arrays(
                    [payloads.slice(k, 512), pa.array(own[k:k + 512], pa.binary()),
                     pa.array(proofs, _PROOF),
                     batch.column(4).take(pa.array([i] * len(proofs), pa.int32()))],
                    names=["payload", "leaf", "proof", "about"],
                )
    release_memory()


def _tree(
    leaves: DataFrame, order: Sequence[str], fanout: int, height: int
) -> tuple[DataFrame, DataFrame]:
    """The partitions of every tree (tree, part, leaves, payloads, ...), and their states after
    the exchange (tree, part, parts, node, proof)."""
    rows = _in_order(leaves, order).withColumn(
        "part", F.floor(F.col("ordinal") / fanout**height)
    )
    sorted_rows = rows.repartition("tree", "part").sortWithinPartitions("tree", "part", "ordinal")
    payload = leaves.schema["payload"].dataType
    schema = T.StructType([
        T.StructField("tree", T.StringType()), T.StructField("part", T.LongType()),
        T.StructField("leaves", T.BinaryType()), T.StructField("payloads", T.ArrayType(payload)),
        T.StructField("root", T.BinaryType()), T.StructField("sole", T.BinaryType()),
    ])
    parts = stored(
        sorted_rows.select("tree", "part", "leaf", "payload").mapInArrow(
            lambda b: _subtrees(b, fanout, height), schema),
        "merkle_parts",
    )
    return parts, _butterfly(parts.select("tree", "part", "root", "sole"), fanout)


def _proofs(parts: DataFrame, upper: DataFrame, fanout: int, height: int) -> DataFrame:
    """(payload, leaf, proof, about) of the leaves of all partitions; ``upper`` are rows
    (tree, part, parts, proof, about) with the siblings above a partition."""
    schema = T.StructType([
        T.StructField("payload", parts.schema["payloads"].dataType.elementType),
        T.StructField("leaf", T.BinaryType()), upper.schema["proof"], upper.schema["about"],
    ])
    return (
        parts.join(upper, ["tree", "part"])
        .select("leaves", "payloads", "parts", "proof", "about")
        .mapInArrow(lambda b: _proved(b, fanout, height), schema)
    )


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group_col: str = "source",
    id_col: str = "doc_id",
    carry: dict[str, Column] | None = None,
    fanout: int = FANOUT,
    height: int = HEIGHT,
) -> DataFrame:
    """(doc_id, group, leaf, subroot, root, proof, and ``carry``) of every row of ``docs``.

    A leaf is the digest of a row's ``fields``.  The leaves of a group ascend by id (null first;
    equal ids by their digests, so the result does not depend on the order of the rows); groups
    ascend bytewise (null first).  While several nodes remain, every ``fanout`` consecutive ones
    become the digest of their hexadecimal digests; a lone leaf is its root.  ``proof`` holds, per
    level up to ``root``, the siblings' digests in order and the number of those before the node;
    ``fold`` recomputes the root from it.  ``carry`` are further columns, of ``docs``.

    Repeated rows are leaves of their own.  Null and empty values have different digests.  No rows
    give no rows.  Other columns are ignored, whatever their names.

    Texts are read once; leaves are written, sorted by ranges, and met by their partitions' proofs.
    Groups of any size, and any number of groups, are dealt to partitions of fanout ** height.
    """
    small_batches(docs.sparkSession)
    carried = carry or {}
    group = column(group_col).cast("string")
    rows = stored(docs.select(
        F.coalesce(F.concat(F.lit("1"), group), F.lit("0")).alias("tree"),
        leaf([column(name) for name in fields]).alias("leaf"),
        F.struct(
            column(id_col).cast("bigint").alias("id"),
            F.struct(*[c.alias(n) for n, c in carried.items()] or [F.lit(None).alias("none")]).alias("more"),
        ).alias("payload"),
        F.monotonically_increasing_id().alias("row"),
    ), "merkle_leaves")
    ordered = rows.select("tree", "leaf", "payload", F.col("payload.id").alias("id"), "row")
    # Rows of one id and digest are told apart by their number, or one task could get them all.
    parts, states = _tree(ordered, ["id", "leaf", "row"], fanout, height)
    # One leaf per group; the tree over them is named like none of the groups.
    groups = states.filter("part = 0").select(
        F.lit("").alias("tree"), F.col("node").alias("leaf"), F.struct("tree").alias("payload"),
        F.col("tree").alias("name"),
    )
    group_parts, group_states = _tree(groups, ["name"], fanout, height)
    above = group_states.withColumn("about", F.struct(F.col("node").alias("root"))).drop("node")
    tops = stored(
        _proofs(group_parts, above, fanout, height).select(
            "payload.tree", F.col("proof").alias("above"),
            F.struct("payload.tree", F.col("leaf").alias("subroot"), "about.root").alias("about"),
        ),
        "merkle_groups",
    )
    upper = states.join(tops, "tree").select(
        "tree", "part", "parts", F.concat("proof", "above").alias("proof"), "about"
    )
    return _proofs(parts, upper, fanout, height).select(
        F.col("payload.id").alias("doc_id"),
        F.when(F.col("about.tree") != "0", F.expr("substring(about.tree, 2)")).alias("group"),
        "leaf", "about.subroot", "about.root", "proof",
        *[F.col("payload.more")[n].alias(n) for n in carried],
    )
