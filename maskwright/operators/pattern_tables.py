"""Lists of regular expressions as tables: patterns that force a label, or block its values.

A list can hold millions of patterns, of which few can match a text.  Each pattern's longest literal
part, one that every match contains, is its key.  A broadcast filter of bounded size names the
pieces of a text that may be such parts; those meet the table by a shuffle join, which names the
patterns worth trying on that text.  One pass over the texts serves all patterns; its cost grows
with the different lengths of the parts.

Patterns without a literal part are tried on every text.  They are handed out in blocks of bounded
size, one pass a block.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from re import _constants as codes
from re import _parser as parser

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.functions.catalog import ALLOW, SCORE_FORCED
from maskwright.operators import lookups
from maskwright.operators.sizing import small_batches, spread
from maskwright.operators.words import Memo
from maskwright.sources.shared import stored

try:
    import ahocorasick
except ImportError:  # without it every literal is searched for by itself
    ahocorasick = None

# Rows and characters of a block.
BLOCK_ROWS, BLOCK_CHARS = 50_000, 8 * 1024 * 1024


def literal_part(pattern: str) -> str:
    """The longest run of characters that every match contains; empty if none is certain."""
    parsed = parser.parse(pattern)
    if parsed.state.flags & re.IGNORECASE:
        return ""
    best, run = "", ""

    def walk(items: Iterable) -> None:
        nonlocal best, run
        for op, value in items:
            if op is codes.LITERAL:
                run += chr(value)
                best = max(best, run, key=len)
                continue
            if op is codes.SUBPATTERN and not value[1] and not value[2]:
                walk(value[3])
                continue
            if op in (codes.MAX_REPEAT, codes.MIN_REPEAT, codes.POSSESSIVE_REPEAT) and value[0] > 0:
                # At least one of them is there, but its neighbours may be others of its kind.
                run = ""
                walk(value[2])
            if op is not codes.AT:
                run = ""

    walk(parsed)
    return best


class Patterns:
    """The patterns of a block, by label, with the automaton over their literal parts.

    ``rows`` are (label, pattern), or (label, pattern, its literal part).  A pattern is compiled
    when it is first tried.
    """

    def __init__(self, rows: Iterable[tuple[str, ...]]) -> None:
        self.rows = list(rows)
        self.compiled: dict[int, re.Pattern] = {}
        keyed: dict[str, list[int]] = {}
        self.always: list[int] = []
        for i, (_, pattern, *known) in enumerate(self.rows):
            part = known[0] if known else literal_part(pattern)
            if part:
                keyed.setdefault(part, []).append(i)
            else:
                self.always.append(i)
        self.keyed, self.automaton = keyed, None
        if ahocorasick is not None and keyed:
            self.automaton = ahocorasick.Automaton()
            for part in keyed:
                self.automaton.add_word(part, part)
            self.automaton.make_automaton()

    def pattern(self, i: int) -> re.Pattern:
        made = self.compiled.get(i)
        if made is None:
            # Past the module's own small cache: a worker meets many patterns, each often.
            made = self.compiled[i] = re.compile(self.rows[i][1])
        return made

    def worth_trying(self, text: str) -> list[int]:
        if self.automaton is not None:
            parts = {part for _, part in self.automaton.iter(text)}
        else:
            parts = {part for part in self.keyed if part in text}
        return sorted([*self.always, *(i for part in parts for i in self.keyed[part])])

    def found(self, text: str) -> list[dict]:
        """Every occurrence of every pattern; empty ones count for nothing."""
        return [
            {"start": m.start(), "end": m.end(), "label": self.rows[i][0], "text": m[0]}
            for i in self.worth_trying(text) for m in self.pattern(i).finditer(text) if m[0]
        ]

    def blocks(self, label: str, text: str) -> bool:
        return any(
            self.rows[i][0] == label and self.pattern(i).search(text) for i in self.worth_trying(text)
        )


@F.pandas_udf(T.StructType().add("part", "string").add("problem", "string"))
def _parts(patterns: pd.Series) -> pd.DataFrame:
    """The literal part of each pattern, or what is wrong with it."""

    def one(pattern: str) -> tuple[str | None, str | None]:
        try:
            empty = re.compile(pattern).match("")
        except re.error as error:
            return None, f"not a pattern: {pattern!r} ({error})"
        if empty:
            return None, f"a list pattern must not match the empty string: {pattern!r}"
        return literal_part(pattern), None

    return pd.DataFrame([one(p) for p in patterns], columns=["part", "problem"], dtype="object")


def pattern_rows(table: DataFrame) -> DataFrame:
    """The distinct rows of a list(label, pattern) with the patterns' literal parts.  The tasks read
    the patterns, each once."""
    listed = table.select("label", "pattern").filter(
        "label IS NOT NULL AND pattern IS NOT NULL").distinct()
    rows = stored(
        spread(listed).withColumn("__parts", _parts("pattern")).select("label", "pattern", "__parts.*"),
        "pattern_parts",
    )
    wrong = rows.agg(F.min("problem")).first()[0]
    if wrong is not None:
        raise ValueError(wrong)
    return rows.select("label", "pattern", "part")


def pattern_blocks(table: DataFrame) -> Iterator[list[tuple[str, str, str]]]:
    """The rows of a list(label, pattern) with the patterns' literal parts, a bounded block at a time."""
    return _blocks(pattern_rows(table))


def _blocks(rows: DataFrame) -> Iterator[list[tuple[str, str, str]]]:
    size = rows.agg(F.count("*").alias("n"), F.sum(F.length("pattern")).alias("chars")).first()
    n = max(1, -(-size["n"] // BLOCK_ROWS), -(-(size["chars"] or 0) // BLOCK_CHARS))
    part = F.pmod(F.xxhash64("label", "pattern"), F.lit(n))
    for i in range(n if size["n"] else 0):
        yield sorted(
            (r["label"], r["pattern"], r["part"]) for r in rows.filter(part == i).collect())


# --- literal parts in texts -------------------------------------------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


class _Windows:
    """Hashes of all pieces of one length of a text, for any length."""

    def __init__(self, text: str) -> None:
        codes = _codes(text).astype(np.uint64) + np.uint64(1)
        # A character weighs a power of the base by its place; a piece's sum is divided by its first
        # weight (the base is odd, so it can be), and equal pieces get equal hashes.
        self.size = len(codes)
        self.powers = np.cumprod(np.full(self.size + 1, _BASE, dtype=np.uint64))
        self.inverse = np.cumprod(np.full(self.size + 1, np.uint64(pow(int(_BASE), -1, 1 << 64)), dtype=np.uint64))
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum(codes * self.powers[:self.size], dtype=np.uint64)))

    def hashes(self, length: int) -> np.ndarray:
        n = max(0, self.size - length + 1)
        out = (self.sums[length:length + n] - self.sums[:n]) * self.inverse[:n] + np.uint64(length)
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        return out ^ (out >> np.uint64(32))


def part_filter(parts: DataFrame, bits: int | None = None) -> tuple[np.ndarray, list[int]]:
    """A Bloom filter of the distinct literal ``parts``, and their lengths.

    Tasks name the bits; the filter has at most ``lookups.FILTER_BITS`` of them.
    """
    lengths = [r[0] for r in parts.select(F.length("part")).distinct().collect()]
    if bits is None:
        wanted = lookups.BITS_EACH * max(1, parts.count())
        bits = min(lookups.FILTER_BITS, max(1 << 16, 1 << (wanted - 1).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(over="ignore"):
                hashes = [_Windows(part).hashes(len(part))[0] for part in batch.column(0).to_pylist()]
                places = lookups._bits(np.array(hashes, dtype=np.uint64), bits).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array((places >> np.uint64(6)).astype(np.int64)),
                 pa.array((np.uint64(1) << (places & np.uint64(63))).view(np.int64))],
                names=["at", "word"],
            )

    set_words = parts.select("part").mapInArrow(run, "at bigint, word bigint")
    table = set_words.groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[table.column("at").to_numpy()] = table.column("word").to_numpy().view(np.uint64)
    return out, sorted(lengths)


def _held(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1) == 1


def _parts_in(texts: Sequence[str | None], bits: np.ndarray, lengths: Sequence[int]) -> set[tuple[int, str]]:
    """(place of the text, piece) of all pieces that the filter may hold."""
    whole = "".join(t or "" for t in texts)
    ends = np.cumsum([len(t or "") for t in texts])
    windows, size, out = _Windows(whole), 64 * len(bits), set()
    for length in lengths:
        # The first probe leaves few for the others.
        hashes = windows.hashes(length)
        first = np.flatnonzero(_held(bits, hashes & np.uint64(size - 1)))
        first = first[_held(bits, lookups._bits(hashes[first], size)).all(axis=0)]
        owner = np.searchsorted(ends, first, "right")
        inside = first + length <= ends[owner]
        out.update((o, whole[i:i + length]) for o, i in zip(owner[inside].tolist(), first[inside].tolist()))
    return out


def parts_found(
    df: DataFrame, text: str, parts: DataFrame, names: Sequence[str], bits: int | None = None
) -> DataFrame:
    """The columns ``names`` of ``df`` once for each of the distinct ``parts`` (part) that the text of
    the row may contain, with the part."""
    small_batches(df.sparkSession)
    held, lengths = part_filter(parts, bits)
    shared = df.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(over="ignore"):
                found = sorted(_parts_in(batch.column(batch.num_columns - 1).to_pylist(), shared.value, lengths))
            rows = pa.array([at for at, _ in found], type=pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i).take(rows) for i in range(batch.num_columns - 1)],
                 pa.array([part for _, part in found], type=pa.string())],
                names=[*names, "part"],
            )

    names = list(names)
    schema = T.StructType([df.schema[c] for c in names]).add("part", "string")
    return df.select(*names, F.col(text).alias("__text")).mapInArrow(run, schema)


def _made(held) -> Patterns:
    """The compiled block, once per process and block."""
    kept = getattr(held, "_made", None)
    if kept is None:
        kept = held._made = Patterns(held.value)
    return kept


def _finder(held) -> Column:
    def run(texts: pd.Series) -> pd.Series:
        patterns = _made(held)
        return pd.Series([[] if t is None else patterns.found(t) for t in texts])

    kind = "array<struct<start:int,end:int,label:string,text:string>>"
    return F.pandas_udf(run, kind).asNondeterministic()


def _blocker(held) -> Column:
    def run(labels: pd.Series, texts: pd.Series) -> pd.Series:
        patterns = _made(held)
        return pd.Series([
            [] if label is None else [patterns.blocks(a, b) for a, b in zip(label, text, strict=True)]
            for label, text in zip(labels, texts, strict=True)
        ])

    return F.pandas_udf(run, "array<boolean>").asNondeterministic()


@F.pandas_udf(T.ArrayType(T.StructType().add("start", "integer").add("end", "integer").add(
    "label", "string").add("text", "string")))
def _occurrences(texts: pd.Series, patterns: pd.Series) -> pd.Series:
    """Every occurrence of each text's own patterns; empty ones count for nothing."""
    return pd.Series([
        [{"start": m.start(), "end": m.end(), "label": p["label"], "text": m[0]}
         for p in own for m in _COMPILED[p["pattern"]].finditer(text) if m[0]]
        for text, own in zip(texts, patterns, strict=True)
    ])


@F.pandas_udf(T.BooleanType())
def _occurs(texts: pd.Series, patterns: pd.Series) -> pd.Series:
    return pd.Series([
        any(_COMPILED[p].search(text) for p in own) for text, own in zip(texts, patterns, strict=True)])


_COMPILED = Memo(re.compile)


def _forced_candidates(found: str) -> Column:
    return F.transform(found, lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), F.lit(ALLOW).alias("precedence"),
        c["label"].alias("label"), c["text"].alias("text"),
        F.lit(SCORE_FORCED).alias("score"), F.lit(None).cast("string").alias("swap"),
    ))


def forced(df: DataFrame, text: str, spans: str, listed: DataFrame) -> DataFrame:
    """Candidates joined by every occurrence of a pattern of listed(label, pattern), forced to
    its label.  ``df`` are numbered rows."""
    order = df.columns
    rows = pattern_rows(listed)
    keyed = rows.filter("part <> ''").groupBy("part").agg(
        F.collect_list(F.struct("label", "pattern")).alias("__patterns"))
    places = stored(
        parts_found(df, text, keyed.select("part"), [lookups.ROW]),
        "pattern_places",
    )
    hits = lookups.value_lookup(
        places, ["part"], lambda values: values.join(keyed, "part", "left"), "__patterns")
    found = hits.groupBy(lookups.ROW).agg(F.flatten(F.collect_list("__patterns")).alias("__own"))
    met = df.join(found, lookups.ROW, "left")
    tried = met.filter("__own IS NOT NULL").withColumn("__found", _occurrences(text, "__own")).withColumn(
        spans, F.concat(spans, _forced_candidates("__found")))
    df = tried.select(*order).unionByName(met.filter("__own IS NULL").select(*order))
    for block in _blocks(rows.filter("part = ''")):
        hits = _finder(df.sparkSession.sparkContext.broadcast(block))
        df = df.withColumn("__found", hits(F.col(text))).withColumn(
            spans, F.concat(spans, _forced_candidates("__found"))).select(*order)
    return df


def unmatched(df: DataFrame, spans: str, listed: DataFrame) -> DataFrame:
    """Candidates without those that a pattern of listed(label, pattern) for their label finds
    something in; forced ones stay.  ``df`` are numbered rows."""
    order = df.columns
    rows = pattern_rows(listed)
    keyed = rows.filter("part <> ''").groupBy("label", "part").agg(
        F.collect_list("pattern").alias("__patterns"))

    def find(values: DataFrame) -> DataFrame:
        values = stored(values, "pattern_values")
        places = parts_found(values, "text", keyed.select("part").distinct(), ["label", "text"])
        tried = places.join(keyed, ["label", "part"]).groupBy("label", "text").agg(
            F.flatten(F.collect_list("__patterns")).alias("__own"))
        hit = tried.filter(_occurs("text", "__own")).select("label", "text", F.lit(True).alias("__listed"))
        return values.join(hit, ["label", "text"], "left")

    cells = lookups._cells(df, spans)
    hits = lookups.value_lookup(cells, ["label", "text"], find, "__listed")

    def change(found: Column) -> Column:
        return F.filter(
            spans, lambda c, i: (c["precedence"] == ALLOW) | F.try_element_at(found, i).isNull())

    df = lookups._back(df, lookups._by_place(hits, "__listed"), spans, change)

    def parts(field: str) -> Column:
        return F.transform(spans, lambda c: c[field])

    for block in _blocks(rows.filter("part = ''")):
        hits = _blocker(df.sparkSession.sparkContext.broadcast(block))
        found = F.when(F.size(spans) > 0, hits(parts("label"), parts("text")))
        left = F.filter(
            spans, lambda c, i: (c["precedence"] == ALLOW) | ~F.get(F.col("__found"), i)
        )
        df = df.withColumn("__found", found).withColumn(
            spans, F.when(F.col("__found").isNull(), F.col(spans)).otherwise(left)).select(*order)
    return df
