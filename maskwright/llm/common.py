"""Shared folder, per-process state and batching of the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import types
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.operators.sizing import small_batches  # noqa: F401
from maskwright.sources.shared import shared_path

# Text of one Arrow batch that is worked on at a time.
CHUNK_CHARS = 512 * 1024


def column(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: its lineage ends there, so a lost
    executor costs only what it was reading, and nothing is computed twice."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the frame does not have, in any case of its letters."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def fits(df: DataFrame, rows: int) -> bool:
    """Whether a frame has at most ``rows`` rows; counts no more than one row beyond."""
    return df.limit(rows + 1).count() <= rows


def release_memory() -> None:
    """Give freed memory back to the system: a worker lives on between tasks, idle or not."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def per_process(key: tuple, make: Callable[[], Any]) -> Any:
    """A value made once per Python worker and kept between its tasks.

    Functions travel to the workers with their code, so module globals start empty in every
    task; a module of the process keeps what is expensive to load.  ``key`` begins with the
    operator: a worker keeps the values of one operator only, so stages that follow each other
    in the same workers do not add up.
    """
    holder = sys.modules.setdefault("_maskwright_process", types.ModuleType("_maskwright_process"))
    kept = holder.__dict__.setdefault("kept", {})
    if key not in kept:
        for other in [k for k in kept if k[0] != key[0]]:
            del kept[other]
        release_memory()
        kept[key] = make()
    return kept[key]


# Longer keys are not remembered, so that a memo is bounded in bytes and not only in entries.
MEMO_KEY = 64


class Memo:
    """A bounded memo of two generations: what was used since the last turn-over survives it."""

    def __init__(self, limit: int, key_length: int = MEMO_KEY) -> None:
        self.limit, self.key_length = limit, key_length
        self.young, self.old, self.passing = {}, {}, []

    def fill(self, lists: Iterable[Iterable], make: Callable[[list], Iterable]) -> dict:
        """A dict that holds the value of every key in ``lists``, until the next call."""
        for key in self.passing:
            del self.young[key]
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        young, unknown = self.young, []
        for key in set().union(*lists):
            if key in young:
                continue
            value = self.old.get(key)
            if value is None:
                unknown.append(key)
            else:
                self.young[key] = value
        if unknown:
            self.young.update(zip(unknown, make(unknown), strict=True))
        self.passing = [key for key in unknown if len(key) > self.key_length]
        return self.young

    def joined(self, lists: list[list], make: Callable[[list], Iterable]) -> list[bytes]:
        """The joined values of the keys of every list.

        Most lists hold known keys only; those are joined at once, without a look at each key.
        """
        out, waiting, known = [], [], self.young.__getitem__
        for i, keys in enumerate(lists):
            try:
                out.append(b"".join(map(known, keys)))
            except KeyError:
                out.append(b"")
                waiting.append(i)
        if waiting:
            known = self.fill([lists[i] for i in waiting], make).__getitem__
            for i in waiting:
                out[i] = b"".join(map(known, lists[i]))
        return out


def chunks(
    batches: Iterable[pa.RecordBatch], text: str, limit: int = CHUNK_CHARS
) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of Arrow batches with their texts as Python values, each slice of about ``limit``
    characters (one long text makes a slice of its own)."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
        begin = size = 0
        for i, value in enumerate(texts):
            length = len(value) if value is not None else 0
            if i > begin and size + length > limit:
                yield batch.slice(begin, i - begin), texts[begin:i]
                begin, size = i, 0
            size += length
        if begin < len(texts):
            yield batch.slice(begin), texts[begin:]
    release_memory()
