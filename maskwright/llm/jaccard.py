"""Similarity join of texts by the Jaccard similarity of their word shingles, with filters under
several global orders of the shingles.

If two sets are similar they share at least o shingles, so under any order of all shingles their
prefixes (the first |x| - o + l of each) share at least l.  A pair becomes a candidate only if it
passes under every order:

1. a random order (the hash): the prefix with l of about a tenth of the set is the set's sample.
   A set of which too few sample shingles occur in any other set is similar to none;
2. the samples' own order, rarest first: similar sets share a shingle of the sample's prefix;
3. two further random orders: of every pair that is compared, with the leader of a group or
   within it, the prefixes must meet under each before all shingles are.

Equal sets are one class.  The candidates of a class that leads a bucket form a group; groups are
compared in blocks of bounded size, within tasks, and only links that connect something are
returned: a group of many copies yields a spanning forest, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskwright.llm.common import (
    MEMO_KEY, chunks, column, fits, free_name, per_process, release_memory, small_batches, stored,
)
from maskwright.llm.components import components

SHINGLE = 3
PERCENT = 90
# Members of a block: a task compares two blocks at a time.
BLOCK = 512
# Row numbers that are broadcast at most (some 70 MB as a hash table); more are joined by shuffle.
BROADCAST_ROWS = 1_000_000
MEMO_WORDS = 150_000
# The random orders beside that of the hashes and the rarest-first one.
FURTHER_ORDERS = (1, 2)
SET_SCHEMA = "row bigint, doc_id bigint, n bigint, fingerprint binary, sample array<bigint>"
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Words(dict):
    """8-byte hashes of words, remembered up to a bound; long words are not."""

    def __missing__(self, word: bytes) -> bytes:
        import xxhash

        value = xxhash.xxh3_64_digest(word)
        if len(word) <= MEMO_KEY:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = value
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * _M1
    return h ^ (h >> np.uint64(32))


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every whole text.

    Words are parted by ASCII white space after A-Z became lower case; a text of fewer words
    than a shingle has its whole sequence as one shingle, one without words an empty set.
    """
    words = per_process(("jaccard",), _Words)
    lists = [text.encode("utf-8", "surrogatepass").lower().split() if text else [] for text in texts]
    raw = b"".join([words[word] for one in lists for word in one])
    hashes = np.frombuffer(raw, dtype="<u8").astype(np.uint64)
    with np.errstate(over="ignore"):
        n = max(0, len(hashes) - size + 1)
        rolled = np.zeros(n, dtype=np.uint64)
        for i in range(size):
            rolled = rolled * (_M2 if i % 2 else _M1) + hashes[i:i + n]
        rolled = _mixed(rolled)
        sets, at = [], 0
        for one in lists:
            k = len(one)
            if k >= size:
                sets.append(np.unique(rolled[at:at + k - size + 1]))
            elif k:
                whole = np.full(1, np.uint64(k))
                for h in hashes[at:at + k]:
                    whole = whole * _M2 + h
                sets.append(_mixed(whole * _M1))
            else:
                sets.append(np.empty(0, dtype=np.uint64))
            at += k
    return sets


def overlap(n: int, percent: int) -> int:
    """Shingles that a set of n shares with any similar set, at least."""
    return -(-percent * n // 100)


def slack(n: int) -> int:
    """How many shingles of the samples are to be shared (the l of a set of n)."""
    return n // 10 + 1


def sample_size(n: int, percent: int) -> int:
    return min(n, n - overlap(n, percent) + slack(n))


def _shared_at_least(n: Column, percent: int) -> Column:
    """Shared sample shingles of a set of n and any similar set, which has overlap(n) at least."""
    least = F.ceil(n * percent / 100).cast("bigint")
    return F.floor(least / 10).cast("bigint") + 1


def _described(
    batches: Iterator[pa.RecordBatch], percent: int, size: int = SHINGLE
) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch, texts in chunks(batches, "text"):
        sets = shingle_sets(texts, size)
        prints = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        samples = [s[:sample_size(len(s), percent)] for s in sets]
        offsets = np.concatenate(([0], np.cumsum([len(s) for s in samples]))).astype(np.int32)
        values = np.concatenate(samples).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(prints, pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
            ],
            names=["row", "doc_id", "n", "fingerprint", "sample"],
        )


def _whole_sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch, texts in chunks(batches, "text"):
        sets = [s.tobytes() for s in shingle_sets(texts, size)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sets, pa.binary())], names=["cid", "shingles"]
        )


def _of_rows(df: DataFrame, ids: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``df`` whose ``row`` is among ``ids``: by broadcast where that is small."""
    return df.join(F.broadcast(ids) if fits(ids, bound) else ids, "row", "left_semi")


def candidate_groups(classes: DataFrame, percent: int) -> DataFrame:
    """(leader, cid): the classes that share a bucket with its leader, the leader among them.

    ``classes`` are rows (cid, n, sample).
    """
    tokens = classes.select("cid", "n", F.explode("sample").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("held")).filter("held > 1")
    by_class = Window.partitionBy("cid")
    rarest_first = by_class.orderBy("held", "token")
    # Shingles of no other sample come first in this order; they make no bucket, but use up
    # places of the prefix.  So many places are left for the others:
    places = F.col("hits") - _shared_at_least(F.col("n"), percent) + 1
    buckets = stored(
        tokens.join(shared, "token")
        .withColumn("hits", F.count("*").over(by_class))
        .filter(places > 0)
        .withColumn("place", F.row_number().over(rarest_first))
        .filter(F.col("place") <= places)
        .select("token", "cid"),
        "jaccard_buckets",
    )
    leaders = buckets.groupBy("token").agg(
        F.min("cid").alias("leader"), F.count("*").alias("members")
    ).filter("members > 1").select("token", "leader")
    return buckets.join(leaders, "token").select("leader", "cid").distinct()


def needed(n: int, percent: int) -> int:
    """How many shingles the prefixes of a set of n and any similar set share, at least."""
    return min(slack(n), overlap(n, percent))


def _prefix(shingles: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The prefix under a random order, as the keys of that order (0: the hashes themselves)."""
    n = len(shingles)
    length = n - overlap(n, percent) + needed(n, percent)
    if order == 0:
        return shingles[:length]
    with np.errstate(over="ignore"):
        keys = _mixed(shingles * np.uint64(2 * order + 1) + _M2)
    return np.partition(keys, length - 1)[:length] if length < n else keys


def similar_sets(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets are similar, by all their shingles."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def verified(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets are similar: prefixes under the further orders first, then all shingles."""
    if percent * max(len(a), len(b)) > 100 * min(len(a), len(b)):
        return False
    least = min(needed(len(a), percent), needed(len(b), percent))
    for order in FURTHER_ORDERS:
        mine, other = _prefix(a, order, percent), _prefix(b, order, percent)
        if len(np.intersect1d(mine, other, assume_unique=True)) < least:
            return False
    return similar_sets(a, b, percent)


class _Index:
    """The sets of a block by the keys of their prefixes under one order."""

    def __init__(self, prefixes: list[np.ndarray]) -> None:
        keys = np.concatenate(prefixes)
        owners = np.repeat(np.arange(len(prefixes)), [len(p) for p in prefixes])
        order = np.argsort(keys, kind="stable")
        self.owners = owners[order]
        self.keys, self.begins, self.counts = np.unique(
            keys[order], return_index=True, return_counts=True
        )

    def shared(self, prefix: np.ndarray, n: int) -> np.ndarray:
        """How many keys of a prefix each of the n sets shares."""
        at = np.searchsorted(self.keys, prefix)
        at[at == len(self.keys)] = 0
        at = at[self.keys[at] == prefix]
        counts, begins = self.counts[at], self.begins[at]
        steps = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        return np.bincount(self.owners[np.repeat(begins, counts) + steps], minlength=n)


class _Block:
    """Sets of one block, with an index of their prefixes under every further order.

    Only sets of fitting sizes whose prefixes share enough under all orders are compared in full.
    """

    def __init__(self, rows: list[tuple[int, np.ndarray]], percent: int) -> None:
        self.percent = percent
        self.cids = np.array([cid for cid, _ in rows], dtype=np.int64)
        self.sets = [s for _, s in rows]
        self.sizes = np.array([len(s) for s in self.sets], dtype=np.int64)
        self.indexes = {
            order: _Index([_prefix(s, order, percent) for s in self.sets])
            for order in (0, *FURTHER_ORDERS)
        }
        self.needed = np.array([needed(len(s), percent) for s in self.sets], dtype=np.int64)
        self.compared = 0

    def similar(self, shingles: np.ndarray) -> list[int]:
        """Places of the sets that are similar to the given one, exactly."""
        n, percent = len(shingles), self.percent
        meets = percent * np.maximum(self.sizes, n) <= 100 * np.minimum(self.sizes, n)
        least = np.minimum(self.needed, needed(n, percent))
        for order, index in self.indexes.items():
            if not meets.any():
                return []
            meets &= index.shared(_prefix(shingles, order, percent), len(self.sets)) >= least
        places = np.flatnonzero(meets)
        self.compared += len(places)
        return [i for i in places.tolist() if similar_sets(self.sets[i], shingles, percent)]


class _Forest:
    """Union-find over the classes of a block: which links connect something new."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent.setdefault(x, x)
        while parent != x:
            self.parent[x] = self.parent.setdefault(parent, parent)
            x, parent = parent, self.parent[parent]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _links(pairs: list[tuple], lonely: list[tuple]) -> pa.RecordBatch:
    """Links (a, b), and as rows with a null b the members that their leader does not reach."""
    rows = [(None, a, b) for a, b in pairs] + [(leader, cid, None) for leader, cid in lonely]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in zip(*rows)], names=["leader", "a", "b"]
    )


def _rows(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple]:
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(keys + 1)]
        for *key, raw in zip(*columns, strict=True):
            yield (*key, np.frombuffer(raw, dtype=np.uint64))
    release_memory()


def _with_leader(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (leader, chunk, rank, cid, shingles), the leader first in each chunk: links to the
    leader, then links of the members it does not reach with the others of the chunk."""
    for (leader, _), rows in groupby(_rows(batches, 4), key=lambda r: r[:2]):
        members = [(cid, shingles) for _, _, _, cid, shingles in rows]
        if members[0][0] != leader:
            raise ValueError("a chunk came without its leader")
        (_, own), rest = members[0], members[1:]
        forest, found, lonely = _Forest(), [], []
        for cid, shingles in rest:
            if verified(own, shingles, percent):
                forest.join(leader, cid)
                found.append((leader, cid))
            else:
                lonely.append((cid, shingles))
        if lonely and len(rest) > 1:
            block = _Block(rest, percent)
            for cid, shingles in lonely:
                for other in block.cids[block.similar(shingles)].tolist():
                    if other != cid and forest.join(cid, other):
                        found.append((cid, other))
        if found or lonely:
            yield _links(found, [(leader, cid) for cid, _ in lonely])


def _across(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (leader, block, chunk, is_member, cid, shingles), a block of lonely members first:
    links between it and the members of one chunk."""
    for _, rows in groupby(_rows(batches, 5), key=lambda r: r[:3]):
        lonely, block, forest, found = [], None, _Forest(), []
        for _, _, _, is_member, cid, shingles in rows:
            if not is_member:
                lonely.append((cid, shingles))
                continue
            if not lonely:
                break  # no lonely member fell into this block
            block = block or _Block(lonely, percent)
            for other in block.cids[block.similar(shingles)].tolist():
                if other != cid and forest.join(cid, other):
                    found.append((cid, other))
        if found:
            yield _links(found, [])


def similar_links(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between similar classes that span the same components as all links.

    ``groups`` are rows (leader, cid), ``sets`` rows (cid, shingles).  A group is dealt out in
    chunks of about ``BLOCK`` members, each with a copy of the leader.  Members that the leader
    does not reach are compared with all others of their chunk; in groups of several chunks they
    are then compared, in blocks, with the members of every other chunk too.
    """
    schema = "leader bigint, a bigint, b bigint"
    sizes = groups.groupBy("leader").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks"))
    sized = stored(groups.join(sizes, "leader"), "jaccard_groups")
    own_chunk = F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int")
    every_chunk = F.sequence(F.lit(0), F.col("chunks") - 1)
    dealt = sized.select(
        "leader", "cid",
        F.explode(F.when(F.col("cid") == F.col("leader"), every_chunk)
                  .otherwise(F.array(own_chunk))).alias("chunk"),
    )
    by_leader = (
        dealt.join(sets, "cid")
        .select("leader", "chunk", (F.col("cid") != F.col("leader")).cast("int").alias("rank"),
                "cid", "shingles")
        .repartition("leader", "chunk").sortWithinPartitions("leader", "chunk", "rank", "cid")
        .mapInArrow(lambda b: _with_leader(b, percent), schema)
    )
    first = stored(by_leader, "jaccard_links")
    large = sized.filter("chunks > 1")
    lonely = first.filter("b IS NULL").select("leader", F.col("a").alias("cid")).join(
        large, ["leader", "cid"]
    )
    blocks = lonely.groupBy("leader").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own_block = F.pmod(F.xxhash64("cid", F.lit(1)), F.col("blocks")).cast("int")
    every_block = F.sequence(F.lit(0), F.col("blocks") - 1)
    sides = (
        lonely.join(blocks, "leader")
        .select("leader", own_block.alias("block"), F.explode(every_chunk).alias("chunk"),
                F.lit(0).alias("is_member"), "cid")
        .unionByName(
            large.join(blocks, "leader").filter("cid <> leader")
            .select("leader", F.explode(every_block).alias("block"), own_chunk.alias("chunk"),
                    F.lit(1).alias("is_member"), "cid")
        )
    )
    second = (
        sides.join(sets, "cid")
        .select("leader", "block", "chunk", "is_member", "cid", "shingles")
        .repartition("leader", "block", "chunk")
        .sortWithinPartitions("leader", "block", "chunk", "is_member", "cid")
        .mapInArrow(lambda b: _across(b, percent), schema)
    )
    return first.filter("b IS NOT NULL").unionByName(second).select("a", "b")


def join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    size: int = SHINGLE,
) -> DataFrame:
    """(row, doc_id, n_shingles, component_id, component) of every row of ``docs``.

    Two texts are linked if their sets of shingles (``size`` words each) have a Jaccard similarity
    of ``percent`` or more;
    ``component_id`` is the smallest id that links reach, the row's own included, and
    ``component`` a number of the component.  ``row`` numbers the rows of ``docs``: they are
    written once with their numbers, and every pass reads those.

    Null and empty texts, and texts without words, have no shingles and are linked with nothing.
    Equal texts and repeated rows are linked.  Null ids take part, but are no component's
    smallest id unless it has no other.  No rows give no rows.  Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    numbered = stored(docs.select(
        F.monotonically_increasing_id().alias("row"),
        column(id_col).cast("bigint").alias("doc_id"),
        column(text_col).alias("text"),
    ), "jaccard_rows")
    return _joined(numbered, percent, size)


def _joined(numbered: DataFrame, percent: int, size: int) -> DataFrame:
    """``join`` of stored rows (row, doc_id, text)."""
    described = stored(
        numbered.mapInArrow(lambda b: _described(b, percent, size), SET_SCHEMA), "jaccard_sets"
    )
    narrow = described.select("row", "doc_id", "n", "fingerprint")
    classes = stored(
        narrow.filter("n > 0").groupBy("fingerprint")
        .agg(F.min("row").alias("cid"), F.min("doc_id").alias("least")),
        "jaccard_classes",
    )
    firsts = _of_rows(described, classes.select(F.col("cid").alias("row")))
    groups = stored(
        candidate_groups(firsts.select(F.col("row").alias("cid"), "n", "sample"), percent),
        "jaccard_candidates",
    )
    compared = groups.select(F.col("cid").alias("row")).distinct()
    sets = stored(
        _of_rows(numbered.select("row", "text"), compared)
        .mapInArrow(lambda b: _whole_sets(b, size), "cid bigint, shingles binary"),
        "jaccard_whole_sets",
    )
    roots = components(similar_links(groups, sets, percent))
    rooted = classes.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn(
        "component", F.coalesce("root", "cid")
    )
    smallest = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = rooted.join(smallest, "component").select(
        "fingerprint", "component", "component_id"
    )
    # Without shingles there is no fingerprint: those rows do not meet in the join.
    alone = narrow.filter("n = 0").select(
        "row", "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
        F.col("row").alias("component"),
    )
    return narrow.filter("n > 0").join(labels, "fingerprint").select(
        "row", "doc_id", F.col("n").alias("n_shingles"), "component_id", "component"
    ).unionByName(alone)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of every component: that with the smallest id (null last), and of
    equal ids the first.  Rows without shingles are components of their own.  Columns stay, of
    whatever names."""
    small_batches(docs.sparkSession)
    number = free_name(docs, "__row")
    numbered = stored(
        docs.withColumn(number, F.monotonically_increasing_id()), "jaccard_rows"
    )
    texts = numbered.select(
        F.col(number).alias("row"),
        column(id_col).cast("bigint").alias("doc_id"),
        column(text_col).alias("text"),
    )
    joined = stored(_joined(texts, percent, size), "jaccard_joined")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    kept = (
        joined.groupBy("component").agg(F.min(order).alias("first"))
        .select(F.col("first.row").alias(number))
    )
    ids = stored(kept, "jaccard_kept")
    chosen = F.broadcast(ids) if fits(ids, BROADCAST_ROWS) else ids
    return numbered.join(chosen, number, "left_semi").drop(number)
