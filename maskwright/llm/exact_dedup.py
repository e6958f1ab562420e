"""Exact deduplication with a heavy-hitter split.

Texts are equal if their digests are.  A shuffle by digest would send a text that a third of all
rows hold to one task, so the frequent digests go another way:

1. every task sums up its digests in a Misra-Gries summary of bounded size; the added summaries
   name all digests held by more than ``1 / HEAVY`` of the rows, and at most ``2 * HEAVY`` others;
2. the named digests are broadcast and counted exactly; those that are frequent indeed are the
   verified winners, each with the row that stays;
3. the winners are broadcast: rows of their digests are decided where they lie;
4. all other digests, none of them frequent, meet by an ordinary shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskwright.llm.common import column, small_batches, stored

# A digest held by more than 1 / HEAVY of all rows is frequent.
HEAVY = 2000
# White space that counts as one space.
SPACE = "[\x20\x09-\x0d]+"


def normalised(text: Column) -> Column:
    """A text with every run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _shrunk(held: dict[bytes, int], counters: int) -> dict[bytes, int]:
    """At most ``counters`` of the counters, all lowered by the largest of those left out."""
    if len(held) <= counters:
        return held
    counts = np.fromiter(held.values(), dtype=np.int64, count=len(held))
    cut = int(np.partition(counts, len(counts) - counters - 1)[len(counts) - counters - 1])
    return {digest: n - cut for digest, n in held.items() if n > cut}


def summary(batches: Iterator[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    """(digest, seen): the Misra-Gries summary of the digests of a task.

    Of n digests, ``seen`` is at most n / counters below the true count.  Counters that are not
    above n / counters are left out, which takes away as much once more.
    """
    held: dict[bytes, int] = {}
    rows = 0
    for batch in batches:
        rows += len(batch)
        counted = batch.column(0).value_counts()
        for digest, n in zip(
            counted.field(0).to_pylist(), counted.field(1).to_pylist(), strict=True
        ):
            held[digest] = held.get(digest, 0) + n
        if len(held) > 2 * counters:
            held = _shrunk(held, counters)
    kept = {d: n for d, n in _shrunk(held, counters).items() if n * counters > rows}
    if kept:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(kept), pa.binary()), pa.array(list(kept.values()), pa.int64())],
            names=["digest", "seen"],
        )


def frequent(rows: DataFrame, total: int, heavy: int = HEAVY) -> DataFrame:
    """(digest): all digests held by more than ``total / heavy`` of the rows, and others, together
    fewer than ``2 * heavy``.

    With 4 * heavy counters a task, the added summaries of a digest are at most
    total / (2 * heavy) below its true count, so frequent ones keep more than that; and as the
    summaries add up to no more than the total, fewer than 2 * heavy digests can.
    """
    counters = 4 * heavy
    return (
        rows.select("digest")
        .mapInArrow(lambda b: summary(b, counters), "digest binary, seen bigint")
        .groupBy("digest").agg(F.sum("seen").alias("seen"))
        .filter(F.col("seen") * (2 * heavy) > total)
        .select("digest")
    )


def _first() -> Column:
    """The row that stays: the smallest id, null last, and of equal ids the first row."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")


def winners(rows: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """(digest, first, size) of the digests held by more than 1 / ``heavy`` of the rows."""
    total = rows.count()
    named = stored(frequent(rows, total, heavy), "dedup_named")
    return stored(
        rows.join(F.broadcast(named), "digest", "left_semi")
        .groupBy("digest").agg(F.min(_first()).alias("first"), F.count("*").alias("size"))
        .filter(F.col("size") * heavy > total),
        "dedup_winners",
    )


def _decided(rows: DataFrame, heavy: int) -> DataFrame:
    """``groups`` of stored rows (row, doc_id, digest)."""
    found = winners(rows, heavy)
    here = rows.join(F.broadcast(found), "digest")
    same = Window.partitionBy("digest")
    rest = (
        rows.join(F.broadcast(found.select("digest")), "digest", "left_anti")
        .withColumn("first", F.min(_first()).over(same))
        .withColumn("size", F.count("*").over(same))
    )
    return here.unionByName(rest).select(
        "row", "doc_id", F.col("first.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"), (F.col("first.row") == F.col("row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    return [
        F.monotonically_increasing_id().alias("row"),
        column(id_col).cast("bigint").alias("doc_id"),
        F.unhex(F.sha2(normalised(column(text_col)), 256)).alias("digest"),
    ]


def groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY
) -> DataFrame:
    """(row, doc_id, keep_id, group_size, kept, text_sha256) of every row of ``docs``.

    Texts are equal if they are after every run of ASCII white space became one space; a null
    text is empty, and empty texts are equal.  Of equal texts the row with the smallest id stays
    (null last; of repeated ids the first row), so exactly one row of a group is ``kept``.
    No rows give no rows.  Other columns are ignored, whatever their names.

    Texts are read once; digests are written with their row numbers and read from there.
    """
    small_batches(docs.sparkSession)
    rows = stored(docs.select(*_numbered(docs, id_col, text_col)), "dedup_digests")
    return _decided(rows, heavy)


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY
) -> DataFrame:
    """The rows of ``docs`` that stay (see ``groups``), with all their columns.

    Copies of frequent texts are dropped by the task that reads them; of the other texts only
    digests are shuffled, and then the rows meet the numbers of those that stay.
    """
    small_batches(docs.sparkSession)
    whole = stored(
        docs.select(*_numbered(docs, id_col, text_col), F.struct(
            *[column(name) for name in docs.columns]).alias("doc")),
        "dedup_rows",
    )
    rows = whole.select("row", "doc_id", "digest")
    found = winners(rows, heavy)
    here = whole.join(F.broadcast(found.select("digest", "first")), "digest").filter(
        F.col("first.row") == F.col("row")
    )
    rest = F.broadcast(found.select("digest"))
    kept = rows.join(rest, "digest", "left_anti").groupBy("digest").agg(
        F.min(_first()).alias("first")
    ).select(F.col("first.row").alias("row"))
    others = whole.join(rest, "digest", "left_anti").join(kept, "row", "left_semi")
    return here.select("doc.*").unionByName(others.select("doc.*"))
