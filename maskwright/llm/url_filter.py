"""URL filter: rules by host and path, and a Bloom filter cascade of listed keys.

A cascade holds a set exactly, relative to a universe of keys that is known when it is built.
Level 1 is a Bloom filter of the listed keys; level 2 one of the unlisted keys that level 1 lets
through; level 3 one of the listed keys that level 2 lets through, and so on until a level lets
nothing through.  A key's first level that rejects it decides: rejected by an odd level it is
unlisted, by an even one listed; passing all, it belongs to the set of the last level.

The universe is cut into shards by hash.  Every shard builds its own small cascade in one task;
urls are judged where they are, without a join, with the filters broadcast in blocks of bounded
size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.llm.common import column, small_batches, stored

# Keys of one shard, about; a shard is built in the memory of one task.
SHARD_KEYS = 200_000
# Bytes of filters that are broadcast at a time; more are applied in further passes.
BLOCK_BYTES = 64 * 1024 * 1024
# False positive rates of the first and of all further levels.
FIRST_RATE, RATE = 0.1, 0.5
MAX_LEVELS = 64


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(at > 0, lower).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return F.when(at > 0, path).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule (``host/path``) that fits, or null.

    A rule fits its host and all subdomains where the path starts with the rule's path.
    """
    fitting = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        site, _, tail = rule.partition("/")
        fits = ((host == site) | host.endswith("." + site)) & path.startswith("/" + tail)
        fitting = F.when(fits, F.lit(rule)).otherwise(fitting)
    return fitting


def _positions(low: np.ndarray, high: np.ndarray, level: int, bits: int, hashes: int) -> np.ndarray:
    """Bit positions of keys (rows) under every hash function (columns) of a level."""
    mix = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        a = (low ^ (np.uint64(level + 1) * mix)) * mix
        a ^= a >> np.uint64(32)
        b = (high + np.uint64(level + 1) * mix) * mix
        b = (b ^ (b >> np.uint64(29))) | np.uint64(1)
        steps = np.arange(hashes, dtype=np.uint64)
        return (a[:, None] + steps[None, :] * b[:, None]) % np.uint64(bits)


def _contains(level: dict, number: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    where = _positions(low, high, number, level["bits"], level["hashes"])
    bits = np.frombuffer(level["filter"], dtype=np.uint8)
    set_ = bits[(where >> np.uint64(3)).astype(np.int64)] >> (where & np.uint64(7)).astype(np.uint8)
    return (set_ & 1).all(axis=1)


def _bloom(number: int, low: np.ndarray, high: np.ndarray, rate: float) -> dict:
    bits = max(64, int(np.ceil(len(low) * np.log2(1 / rate) / np.log(2))))
    hashes = max(1, round(np.log2(1 / rate)))
    flags = np.zeros((bits + 7) // 8 * 8, dtype=np.uint8)
    flags[_positions(low, high, number, bits, hashes).ravel().astype(np.int64)] = 1
    return {
        "bits": bits, "hashes": hashes, "filter": np.packbits(flags, bitorder="little").tobytes(),
    }


def build_levels(low: np.ndarray, high: np.ndarray, listed: np.ndarray) -> list[dict]:
    """The cascade of one shard; keys are given as two 64-bit hashes each."""
    inside, outside = (low[listed], high[listed]), (low[~listed], high[~listed])
    levels: list[dict] = []
    while len(inside[0]):
        if len(levels) == MAX_LEVELS:
            raise ValueError("a listed and an unlisted key have equal hashes")
        level = _bloom(len(levels), *inside, RATE if levels else FIRST_RATE)
        levels.append(level)
        passing = _contains(level, len(levels) - 1, *outside) if len(outside[0]) else []
        # What this level lets through must be held by the next.
        inside, outside = tuple(x[passing] for x in outside) if len(passing) else (
            outside), inside
    return levels


def is_listed(levels: list[dict], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Membership of keys of the universe; keys outside it may get either answer."""
    out = np.zeros(len(low), dtype=bool)
    open_ = np.arange(len(low))
    for number, level in enumerate(levels):
        if not len(open_):
            break
        passed = _contains(level, number, low[open_], high[open_])
        out[open_[~passed]] = number % 2 == 1
        open_ = open_[passed]
    if levels:
        out[open_] = len(levels) % 2 == 1
    return out


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit(1), key)


def build(keys: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """Filters of (key, listed) rows: (shard, levels) rows, stored, and the number of shards.

    The rows are the whole universe, repeated keys and all; a key is listed if any of its rows
    says so.  Equal keys are combined before the shuffle, so a frequent key costs one row per
    task.  Null keys are left out.  No keys give no filters.
    """
    low, high = _hashes(F.col("key"))
    universe = stored(
        keys.filter("key IS NOT NULL").groupBy("key")
        .agg(F.max(F.coalesce("listed", F.lit(False))).alias("listed"))
        .select(low.alias("low"), high.alias("high"), "listed"),
        "url_universe",
    )
    shards = max(1, -(-universe.count() // shard_keys))

    def one(group: pd.DataFrame) -> pd.DataFrame:
        levels = build_levels(
            group["low"].to_numpy(np.int64).view(np.uint64),
            group["high"].to_numpy(np.int64).view(np.uint64),
            group["listed"].to_numpy(bool),
        )
        return pd.DataFrame({
            "shard": int(group["shard"].iloc[0]),
            "level": range(len(levels)),
            "bits": [x["bits"] for x in levels],
            "hashes": [x["hashes"] for x in levels],
            "filter": [x["filter"] for x in levels],
        })

    filters = (
        universe.withColumn("shard", F.pmod("high", F.lit(shards)).cast("int"))
        .groupBy("shard")
        .applyInPandas(one, "shard int, level int, bits bigint, hashes int, filter binary")
    )
    return stored(filters, "url_filters"), shards


def judge(
    rows: DataFrame,
    key_col: str,
    filters: DataFrame,
    shards: int,
    out: str = "listed",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``rows`` with a boolean column: whether the key is listed (null keys are not).

    Filters reach the tasks by broadcast, in blocks whose size was measured first; rows whose
    shard lies in another block wait for its pass.  One block is the usual case: a filter has a
    few bits per listed key.
    """
    small_batches(rows.sparkSession)
    sizes = (
        filters.groupBy("shard").agg(F.sum(F.length("filter")).alias("bytes"))
        .orderBy("shard").toLocalIterator()
    )
    blocks: list[list] = [[0, 0]]  # first shard, bytes
    for size in sizes:
        if blocks[-1][1] and blocks[-1][1] + size["bytes"] > block_bytes:
            blocks.append([size["shard"], 0])
        blocks[-1][1] += size["bytes"]
    bounds = [b[0] for b in blocks] + [shards]
    low, high = _hashes(column(key_col))
    hashed = rows.withColumn("__low", low).withColumn("__high", high).withColumn(
        out, F.lit(False)
    )
    context = rows.sparkSession.sparkContext
    for first, last in zip(bounds[:-1], bounds[1:], strict=True):
        levels: dict[int, list[dict]] = {}
        for row in filters.filter(F.col("shard").between(first, last - 1)).orderBy(
            "shard", "level"
        ).collect():
            levels.setdefault(row["shard"], []).append(
                {"bits": row["bits"], "hashes": row["hashes"], "filter": bytes(row["filter"])}
            )
        hashed = hashed.mapInArrow(_judge(context.broadcast(levels), shards, key_col, out),
                                   hashed.schema)
    return hashed.drop("__low", "__high")


def _judge(held, shards: int, key_col: str, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = held.value
        for batch in batches:
            names = batch.schema.names
            low = batch.column(names.index("__low")).to_numpy(zero_copy_only=False)
            high = batch.column(names.index("__high")).to_numpy(zero_copy_only=False)
            shard = np.mod(high, shards)
            verdict = np.array(batch.column(names.index(out)).to_numpy(zero_copy_only=False), bool)
            for s in np.unique(shard):
                if int(s) in levels:
                    mine = np.flatnonzero(shard == s)
                    verdict[mine] = is_listed(
                        levels[int(s)], low[mine].view(np.uint64), high[mine].view(np.uint64)
                    )
            known = batch.column(names.index(key_col)).is_valid().to_numpy(zero_copy_only=False)
            columns = list(batch.columns)
            columns[names.index(out)] = pa.array(verdict & known)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def filter_urls(
    pages: DataFrame,
    listed: DataFrame | Column,
    rules: Sequence[tuple[str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every url.

    ``rules`` are pairs such as ``("net/es/", "block")``; the longest that fits decides.  Other
    urls are judged by the cascade: their host is a key, and the universe are all hosts of
    ``pages``.  ``listed`` is a table of listed keys (``key``: hosts; repeated and null ones, and
    hosts that no page has, do no harm), or a condition on the columns ``host`` and ``path``.
    List and universe are united by aggregation, not joined.  ``pages`` is read twice.

    A null url, or one without ``://``, has an empty host and path, fits no rule and is allowed
    unless the empty host is listed.  Every row is judged, repeated rows and ids included.  No
    rows give no rows.  Other columns are ignored.
    """
    url = F.coalesce(column(url_col), F.lit(""))
    parsed = pages.select(
        column(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    if isinstance(listed, DataFrame):
        universe = parsed.select(F.col("host").alias("key"), F.lit(False).alias("listed")).unionByName(
            listed.select(F.col("key").cast("string").alias("key"), F.lit(True).alias("listed")))
    else:
        universe = parsed.select(F.col("host").alias("key"), listed.alias("listed"))
    filters, shards = build(universe)
    ruled = parsed.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules:
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    by_list = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return judge(ruled, "host", filters, shards).select(
        "page_id", "host", "path", "rule", F.coalesce(by_rule, by_list).alias("verdict")
    )
