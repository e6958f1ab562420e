"""Words of texts as rows, found by Python workers: a text is cut in one pass, however long it is.

Nothing but Arrow and NumPy is imported here, so workers start quickly.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

# The words that [\p{L}\p{N}]+ finds.
WORDS = re.compile(r"[^\W_]+")
_REPEATED = re.compile(r"(.)\1+")
# Rows that leave Python at a time, about.
BATCH_ROWS = 1 << 16
# Words remembered, and the longest of them.
MEMO_WORDS, MEMO_LENGTH = 100_000, 64


class Memo(dict):
    """What a function makes of a word; short words are remembered, up to a bound."""

    def __init__(self, function) -> None:
        super().__init__()
        self.function = function

    def __missing__(self, word: str):
        value = self.function(word)
        if len(word) <= MEMO_LENGTH:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = value
        return value


def shape(word: str) -> str:
    """Capitals as X, other letters as x, numbers as 9; repeats once."""
    kinds = (unicodedata.category(c) for c in word)
    return _REPEATED.sub(r"\1", "".join("X" if k == "Lu" else "x" if k[0] == "L" else "9" for k in kinds))


class Rows:
    """Columns of rows that leave as batches of about ``BATCH_ROWS``."""

    def __init__(self, names: Sequence[str], types: Sequence[pa.DataType]) -> None:
        self.names, self.types = list(names), list(types)
        self.columns: list[list] = [[] for _ in names]

    def add(self, *columns: Sequence) -> None:
        for own, more in zip(self.columns, columns, strict=True):
            own.extend(more)

    def full(self, least: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
        if len(self.columns[0]) >= least:
            arrays = [pa.array(c, kind) for c, kind in zip(self.columns, self.types)]
            yield pa.RecordBatch.from_arrays(arrays, names=self.names)
            for column in self.columns:
                column.clear()


def _covered(found: list[re.Match], spans: list[dict]) -> list[bool]:
    """Which words of a text overlap a span."""
    ordered = sorted((s["start"], s["end"]) for s in spans)
    reach = np.maximum.accumulate(np.array([-1, *[e for _, e in ordered]], dtype=np.int64))
    ends = np.array([m.end() for m in found], dtype=np.int64)
    before = np.searchsorted(np.array([s for s, _ in ordered], dtype=np.int64), ends, "left")
    return (reach[before] > np.array([m.start() for m in found], dtype=np.int64)).tolist()


def in_context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(before, word, after, shape, target) of every word of (content, spans)."""
    rows = Rows(["before", "word", "after", "shape", "target"], [pa.string()] * 4 + [pa.bool_()])
    shapes = Memo(shape)
    for part in batches:
        for content, spans in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            found = list(WORDS.finditer(content or ""))
            words = [m[0] for m in found]
            if words:
                targets = _covered(found, spans) if spans else [False] * len(words)
                rows.add(["", *words[:-1]], words, [*words[1:], ""], [shapes[w] for w in words], targets)
                yield from rows.full()
    yield from rows.full(1)


def word_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, start, word) of every word of (id, text)."""
    for part in batches:
        rows = Rows(["at", "start", "word"], [pa.int64(), pa.int32(), pa.string()])

        def named(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [ids.take(batch.column(0)), batch.column(1), batch.column(2)], names=["id", "start", "word"])

        ids = part.column(0)
        for at, text in enumerate(part.column(1).to_pylist()):
            found = list(WORDS.finditer(text or ""))
            rows.add([at] * len(found), [m.start() for m in found], [m[0] for m in found])
            yield from map(named, rows.full())
        yield from map(named, rows.full(1))
