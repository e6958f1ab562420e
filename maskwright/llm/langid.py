"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  The vector of an n-gram is the product of its
letters' vectors, each permuted (rotated) by its position; a text's profile is the sum of the
vectors of its n-grams.  A language's prototype is the sum over its training texts.  A text is
given the language whose prototype has the largest cosine with its profile.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.llm.common import chunks, column, per_process, small_batches, stored

DIMENSIONS = 1024
GRAM = 3
SEED = 20_240_117
UNKNOWN = "und"
# Letters and n-grams that a Python worker numbers; texts with others take a slower path.
LETTERS = 128
MEMO_GRAMS = 16_384
# Texts, and n-grams, of one matrix product.
BLOCK_TEXTS, BLOCK_GRAMS = 256, 1024
# The model is one vector per language; more languages than this are refused, not dropped.
MAX_LANGUAGES = 5_000
_GAP, _NEW, _OTHER = 0, -1, -2


class Profiles:
    """Profiles of texts: a fixed random encoding, the same in every process."""

    def __init__(self, dimensions: int, gram: int, seed: int) -> None:
        self.dimensions, self.gram, self.seed = dimensions, gram, seed
        self.letters: dict[int, np.ndarray] = {}
        # Numbers of code points (gaps, letters, not seen yet, letters beyond the bound).
        self.numbers = np.full(0x110000, _NEW, dtype=np.int32)
        self.points = [0]
        self.rows = np.full(LETTERS**gram, -1, dtype=np.int32)
        self.known = 0
        # Products of +1 and -1: a byte each.
        self.vectors = np.empty((MEMO_GRAMS, dimensions), dtype=np.int8)

    def _letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            if len(self.letters) >= MEMO_GRAMS:
                self.letters.clear()
            random = np.random.default_rng((self.seed, point))
            self.letters[point] = random.integers(0, 2, self.dimensions, dtype=np.int8) * 2 - 1
        return self.letters[point]

    def _gram_vector(self, points: list[int]) -> np.ndarray:
        """The product of the letters' vectors, each rotated by its place; gaps are a letter."""
        out = np.ones(self.dimensions, dtype=np.int8)
        for place, point in enumerate(points):
            out *= np.roll(self._letter(point), place)
        return out

    def _line(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The lower-cased letters, one gap between, before and after words: as code points (0
        for a gap) and as numbers."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        numbers = self.numbers[points]
        if (numbers == _NEW).any():
            for point in np.unique(points[numbers == _NEW]).tolist():
                if unicodedata.category(chr(point))[0] != "L":
                    self.numbers[point] = _GAP
                elif len(self.points) < LETTERS:
                    self.numbers[point] = len(self.points)
                    self.points.append(point)
                else:
                    self.numbers[point] = _OTHER
            numbers = self.numbers[points]
        line = np.zeros(len(points) + 2, dtype=np.int64)
        line[1:-1] = np.where(numbers != _GAP, points, 0)
        gap = line == 0
        keep = ~(gap & np.concatenate(([False], gap[:-1])))
        numbered = np.zeros(len(line), dtype=np.int64)
        numbered[1:-1] = numbers
        return line[keep], numbered[keep]

    def _rows_of(self, numbers: np.ndarray) -> np.ndarray | None:
        """The rows of a line's n-grams in ``vectors``; None if they have no room there."""
        if (numbers == _OTHER).any():
            return None
        n = len(numbers) - self.gram + 1
        code = np.zeros(n, dtype=np.int64)
        for place in range(self.gram):
            code = code * LETTERS + numbers[place:place + n]
        rows = self.rows[code]
        if (rows < 0).any():
            fresh = np.unique(code[rows < 0]).tolist()
            if self.known + len(fresh) > MEMO_GRAMS:
                return None
            for one in fresh:
                places = [one // LETTERS**i % LETTERS for i in range(self.gram - 1, -1, -1)]
                self.vectors[self.known] = self._gram_vector([self.points[p] for p in places])
                self.rows[one] = self.known
                self.known += 1
            rows = self.rows[code]
        return rows

    def _summed(self, line: np.ndarray) -> np.ndarray:
        """The profile of a line whose n-grams have no rows."""
        grams = np.lib.stride_tricks.sliding_window_view(line, self.gram)
        kinds, counts = np.unique(grams, axis=0, return_counts=True)
        total = np.zeros(self.dimensions, dtype=np.int64)
        for kind, count in zip(kinds.tolist(), counts.tolist(), strict=True):
            total += count * self._gram_vector(kind).astype(np.int64)
        return total

    def counted(self, text: str | None) -> tuple[np.ndarray | None, np.ndarray | None]:
        """(rows, None), or (None, profile) where rows have no room; neither without letters."""
        if not text:
            return None, None
        line, numbers = self._line(text)
        if len(line) < max(3, self.gram):
            return None, None
        rows = self._rows_of(numbers)
        return (rows, None) if rows is not None else (None, self._summed(line))

    def profiles(self, texts: list[str | None]) -> Iterator[np.ndarray | None]:
        """The summed vectors of each text's n-grams; None for a text without letters."""
        for i in range(0, len(texts), BLOCK_TEXTS):
            part = [self.counted(text) for text in texts[i:i + BLOCK_TEXTS]]
            lines = [rows for rows, _ in part if rows is not None]
            sums = iter(self._products(lines) if lines else ())
            for rows, profile in part:
                yield next(sums).astype(np.float64) if rows is not None else profile

    def _products(self, lines: list[np.ndarray]) -> np.ndarray:
        """The profiles of lines given as rows of ``vectors``: counts times vectors, over the
        n-grams that occur, in blocks."""
        used, places = np.unique(np.concatenate(lines), return_inverse=True)
        owners = np.repeat(np.arange(len(lines)), [len(rows) for rows in lines])
        order = np.argsort(places, kind="stable")
        places, owners = places[order], owners[order]
        sums = np.zeros((len(lines), self.dimensions), dtype=np.float32)
        for begin in range(0, len(used), BLOCK_GRAMS):
            a, b = np.searchsorted(places, [begin, begin + BLOCK_GRAMS])
            width = min(BLOCK_GRAMS, len(used) - begin)
            counts = np.bincount(
                owners[a:b] * width + places[a:b] - begin, minlength=len(lines) * width
            ).reshape(len(lines), width).astype(np.float32)
            sums += counts @ self.vectors[used[begin:begin + width]].astype(np.float32)
        return sums

    def weighted(self, count: np.ndarray) -> np.ndarray:
        """The sum of the vectors of all rows, each as often as counted."""
        used, total = np.flatnonzero(count), np.zeros(self.dimensions, dtype=np.int64)
        for begin in range(0, len(used), BLOCK_GRAMS):
            some = used[begin:begin + BLOCK_GRAMS]
            part = count[some].astype(np.float64) @ self.vectors[some].astype(np.float64)
            total += np.rint(part).astype(np.int64)
        return total


def _profiles(dimensions: int, gram: int, seed: int) -> Profiles:
    return per_process(
        ("langid", dimensions, gram, seed), lambda: Profiles(dimensions, gram, seed)
    )


def train(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    dimensions: int = DIMENSIONS,
    gram: int = GRAM,
    seed: int = SEED,
) -> DataFrame:
    """(lang, position, value): the prototype of every language, over all rows of ``docs``.

    Every task adds up its texts per language; the sums are then added by position, so a
    language held by most rows is one small row set per task.  The sums are whole numbers, so
    the result does not depend on the order.  Rows with a null language, and texts that are null
    or have no letter, teach nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = _profiles(dimensions, gram, seed)
        # A sum is linear in the counts: n-grams are counted per language and weighted once.
        counts, sums = {}, {}
        for batch, texts in chunks(batches, "text"):
            for lang, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                rows, profile = profiles.counted(text)
                if rows is not None:
                    if lang not in counts:
                        counts[lang] = np.zeros(MEMO_GRAMS, dtype=np.int64)
                    counts[lang][:profiles.known] += np.bincount(rows, minlength=profiles.known)
                elif profile is not None:
                    sums[lang] = sums.get(lang, 0) + profile
        for lang, count in counts.items():
            sums[lang] = sums.get(lang, 0) + profiles.weighted(count)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array(list(sums), dtype=object), dimensions), pa.string()),
                    pa.array(np.tile(np.arange(dimensions, dtype=np.int32), len(sums))),
                    pa.array(np.concatenate(list(sums.values()))),
                ],
                names=["lang", "position", "value"],
            )

    small_batches(docs.sparkSession)
    rows = docs.select(column(lang_col).alias("lang"), column(text_col).alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    return (
        rows.mapInArrow(run, "lang string, position int, value bigint")
        .groupBy("lang", "position").agg(F.sum("value").alias("value"))
    )


def predict(
    docs: DataFrame,
    prototypes: DataFrame,
    text_col: str = "text",
    lang_out: str = "lang_pred",
    score_out: str = "score",
    dimensions: int = DIMENSIONS,
    gram: int = GRAM,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with the language of each whole text and its cosine (0 to 1).

    The model goes to the tasks by broadcast: one vector per language, ``MAX_LANGUAGES`` at
    most.  Equal cosines go to the first language in order.  A text that is null or has no
    letter gets ``und`` and 0.0, as does every text if there is no prototype.  Rows and their
    other columns stay as they are; columns named like an output are replaced by it.
    """
    if text_col.lower() in (lang_out.lower(), score_out.lower()):
        raise ValueError("the text cannot be replaced by an output")
    prototypes = stored(prototypes, "langid_prototypes")
    docs = docs.drop(lang_out, score_out)
    names = sorted(r["lang"] for r in prototypes.select("lang").distinct().limit(
        MAX_LANGUAGES + 1).collect())
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    matrix = np.zeros((len(names), dimensions))
    index = {name: i for i, name in enumerate(names)}
    for row in prototypes.toLocalIterator():
        matrix[index[row["lang"]], row["position"]] = row["value"]
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix = matrix / np.where(norms > 0, norms, 1)
    model = docs.sparkSession.sparkContext.broadcast((names, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = _profiles(dimensions, gram, seed)
        langs, prototype = model.value
        for batch, texts in chunks(batches, text_col):
            predicted, scores = [], []
            for profile in profiles.profiles(texts):
                if not langs:
                    profile = None
                norm = float(np.linalg.norm(profile)) if profile is not None else 0.0
                if not norm:
                    predicted.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cosines = prototype @ profile / norm
                best = int(np.argmax(cosines))
                predicted.append(langs[best])
                scores.append(min(1.0, max(0.0, float(cosines[best]))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(predicted, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, lang_out, score_out],
            )

    small_batches(docs.sparkSession)
    schema = T.StructType([
        *docs.schema.fields,
        T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType()),
    ])
    return docs.mapInArrow(run, schema)


def in_fold(id_col: str, fold: int = 2, folds: int = 4) -> Column:
    """Whether crc32 of the id's text leaves the remainder ``fold``; false for a null id."""
    remainder = F.crc32(column(id_col).cast("string").cast("binary")) % folds
    return F.coalesce(remainder == fold, F.lit(False))


def train_on_folds(docs: DataFrame, id_col: str = "doc_id", **names: str) -> DataFrame:
    """Prototypes of all rows outside the held-out fold (rows without an id teach nothing)."""
    return train(docs.filter(column(id_col).isNotNull() & ~in_fold(id_col)), **names)
