"""Tables of any size that meet the candidates of texts: swaps, blocked values, pools, phrases.

Texts do not travel to a table.  They are written once with row numbers; the distinct values of
their candidates are counted and meet the table by a shuffle join; what was found meets the
candidates, and comes back to the rows by number.  A value that many candidates share would be a
hot key in the second join: the few values that hold more than 1 / ``HOT`` of all candidates go by
broadcast instead.  No table passes the driver, and rows with a NULL or repeated key are treated
like all others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.functions.catalog import ALLOW, CUSTOM, SCORE_PATTERN
from maskwright.functions.generators import keyed_hash
from maskwright.operators.sizing import broadcast_if_bounded, lookup_join, small_batches
from maskwright.operators.words import WORDS, Memo, Rows
from maskwright.sources.shared import stored

# Values held by more than 1 / HOT of the candidates are broadcast; there are fewer than HOT.
HOT = 2000
ROW, AT = "__row", "__at"
# Bits of the filter of phrases, at most (64 MB), and bits and probes of a phrase.
FILTER_BITS, BITS_EACH, PROBES = 1 << 29, 16, 4
_MIX = np.uint64(0x9E3779B97F4A7C15)


def numbered(df: DataFrame) -> DataFrame:
    """The rows with their numbers, written once: every later pass reads the same numbers."""
    if df.isStreaming:
        raise ValueError("tables are looked up in batches: use foreachBatch on a stream")
    return stored(df.withColumn(ROW, F.monotonically_increasing_id()), "lookup_rows")


def value_lookup(
    cells: DataFrame, keys: Sequence[str], find: Callable[[DataFrame], DataFrame], value: str,
    hot: int = HOT,
) -> DataFrame:
    """``cells`` with what was found for their ``keys``; cells without are left out.

    ``find`` gives distinct keys (with a count ``__n``) their ``value``, and keeps every one.
    """
    keys = list(keys)
    known = stored(
        find(cells.groupBy(*keys).agg(F.count("*").alias("__n"))).select(*keys, "__n", value),
        "lookup_values",
    )
    total = known.agg(F.sum("__n")).first()[0] or 0
    often = F.broadcast(known.filter(F.col("__n") * hot > total).drop("__n"))
    seldom = known.filter((F.col("__n") * hot <= total) & F.col(value).isNotNull()).drop("__n")
    return (
        cells.join(often, keys).filter(F.col(value).isNotNull())
        .unionByName(cells.join(often.select(*keys), keys, "left_anti").join(seldom, keys))
    )


def _cells(df: DataFrame, spans: str) -> DataFrame:
    """(row, place, label, text) of every candidate."""
    slim = F.transform(spans, lambda c: F.struct(c["label"].alias("label"), c["text"].alias("text")))
    return df.select(ROW, F.posexplode(slim).alias(AT, "__c")).select(
        ROW, AT, "__c.label", "__c.text"
    )


def _back(df: DataFrame, found: DataFrame, spans: str, change: Callable[[Column], Column]) -> DataFrame:
    """The rows with changed candidates; ``found`` are rows (row, found).

    Only rows with candidates meet what was found.
    """
    order = df.columns
    hit = F.coalesce(F.size(spans) > 0, F.lit(False))
    met = df.filter(hit).join(found, ROW, "left").withColumn(
        spans, F.when(F.col("__found").isNull(), F.col(spans)).otherwise(change(F.col("__found")))
    )
    return met.select(*order).unionByName(df.filter(~hit).select(*order))


def _by_place(hits: DataFrame, value: str) -> DataFrame:
    """(row, found): per row, a map from the place of a candidate to its value."""
    entry = F.struct(AT, value)
    return hits.groupBy(ROW).agg(F.map_from_entries(F.collect_list(entry)).alias("__found"))


def _swap_in(spans: str) -> Callable[[Column], Column]:
    """Put what was found into ``swap``, where nothing is there yet."""
    fields = ("start", "end", "precedence", "label", "text", "score")

    def change(found: Column) -> Column:
        return F.transform(spans, lambda c, i: F.struct(
            *[c[f].alias(f) for f in fields],
            F.coalesce(c["swap"], F.try_element_at(found, i)).alias("swap"),
        ))

    return change


def swapped(df: DataFrame, spans: str, swaps: DataFrame, hot: int = HOT) -> DataFrame:
    """Candidates with the replacement that swaps(label, original, replacement) names; of
    several the smallest.  ``df`` are numbered rows."""
    table = swaps.select("label", F.col("original").alias("text"), "replacement").filter(
        "label IS NOT NULL AND text IS NOT NULL").groupBy("label", "text").agg(
        F.min("replacement").alias("replacement"))
    hits = value_lookup(
        _cells(df, spans), ["label", "text"],
        lambda values: values.join(table, ["label", "text"], "left"), "replacement", hot,
    )
    return _back(df, _by_place(hits, "replacement"), spans, _swap_in(spans))


def unblocked(df: DataFrame, spans: str, listed: DataFrame, hot: int = HOT) -> DataFrame:
    """Candidates without those whose (label, text) is in blocks(label, pattern); forced ones
    stay.  ``df`` are numbered rows."""
    table = listed.select("label", F.col("pattern").alias("text")).filter(
        "label IS NOT NULL AND text IS NOT NULL").distinct().withColumn("__listed", F.lit(True))
    hits = value_lookup(
        _cells(df, spans), ["label", "text"],
        lambda values: values.join(table, ["label", "text"], "left"), "__listed", hot,
    )

    def change(found: Column) -> Column:
        return F.filter(
            spans, lambda c, i: (c["precedence"] == ALLOW) | F.try_element_at(found, i).isNull()
        )

    return _back(df, _by_place(hits, "__listed"), spans, change)


def drawn(df: DataFrame, spans: str, pools: DataFrame, key: str, hot: int = HOT) -> DataFrame:
    """Candidates with a replacement drawn from pools(label, position, replacement).

    The positions of a label are 0, 1, 2, ...; a value draws the position that its keyed hash
    leaves on division by the size of the pool.  ``df`` are numbered rows.
    """
    sizes = pools.groupBy("label").agg(F.count("*").alias("__size"))

    def find(values: DataFrame) -> DataFrame:
        placed = lookup_join(values, sizes, ["label"], "left", ["text"]).withColumn(
            "position", keyed_hash(key, F.col("label"), F.col("text")) % F.col("__size")
        )
        named = pools.select("label", F.col("position").cast("long").alias("position"), "replacement")
        # A place of a small pool is drawn by many values: those places are few.
        tiny = sizes.filter(F.col("__size") <= hot).select("label")
        few = broadcast_if_bounded(named.join(F.broadcast(tiny), "label"))
        small = F.coalesce(F.col("__size") <= hot, F.lit(False))
        columns = [*values.columns, "replacement"]
        return (
            placed.filter(small).join(few, ["label", "position"], "left").select(*columns)
            .unionByName(placed.filter(~small).join(named, ["label", "position"], "left").select(*columns))
        )

    hits = value_lookup(_cells(df, spans), ["label", "text"], find, "replacement", hot)
    return _back(df, _by_place(hits, "replacement"), spans, _swap_in(spans))


# --- phrases --------------------------------------------------------------------------------

def _hash(word: str) -> int:
    return int.from_bytes(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest())


def _rolled(words: np.ndarray, length: int) -> np.ndarray:
    """The hashes of all runs of ``length`` words."""
    n = max(0, len(words) - length + 1)
    out = np.full(n, np.uint64(length))
    for i in range(length):
        out = (out ^ words[i:i + n]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def _bits(hashes: np.ndarray, size: int) -> np.ndarray:
    """The places of each hash in a filter of ``size`` bits (a power of two), a row per probe."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return np.stack([(hashes + np.uint64(i) * step) & np.uint64(size - 1) for i in range(PROBES)])


def phrases_of(dictionary: DataFrame) -> DataFrame:
    """(phrase, labels, words): the distinct phrases of dictionary(label, word), their words
    parted by one space."""

    def run(phrases: pd.Series) -> pd.Series:
        return phrases.map(lambda p: " ".join(WORDS.findall(p)))

    plain = F.pandas_udf(run, "string")
    return (
        dictionary.filter("label IS NOT NULL AND word IS NOT NULL")
        .select("label", plain("word").alias("phrase")).filter("phrase <> ''")
        .groupBy("phrase").agg(F.sort_array(F.collect_set("label")).alias("labels"))
        .withColumn("words", F.size(F.split("phrase", " ")))
    )


def phrase_filter(phrases: DataFrame, bits: int | None = None) -> tuple[np.ndarray, list[int]]:
    """A Bloom filter of phrases, and the numbers of words that they have.

    Tasks name the bits; the filter has at most ``FILTER_BITS`` of them, whatever the table.
    """
    lengths = [r["words"] for r in phrases.select("words").distinct().collect()]
    if bits is None:
        wanted = BITS_EACH * max(1, phrases.count())
        bits = min(FILTER_BITS, max(1 << 16, 1 << (wanted - 1).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Memo(_hash)
        for batch in batches:
            one = [
                _rolled(np.array([hashes[w] for w in phrase.split(" ")], dtype=np.uint64), n)[0]
                for phrase, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            ]
            places = _bits(np.array(one, dtype=np.uint64), bits).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array((places >> np.uint64(6)).astype(np.int64)),
                 pa.array((np.uint64(1) << (places & np.uint64(63))).view(np.int64))],
                names=["at", "word"],
            )

    with np.errstate(over="ignore"):
        set_words = phrases.select("phrase", "words").mapInArrow(run, "at bigint, word bigint")
    # As many rows as the filter has words of 64 bits, at most; sent as whole columns.
    table = set_words.groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[table.column("at").to_numpy()] = table.column("word").to_numpy().view(np.uint64)
    return out, sorted(lengths)


def _runs_of(
    text: str, hashes: Memo, bits: np.ndarray, lengths: Sequence[int]
) -> Iterator[tuple[list, list, list, list]]:
    """The runs of words, parted by white space, that the filter may hold, for each length: starts,
    ends, phrases, and texts where they differ from the phrases."""
    found = list(WORDS.finditer(text))
    names = [m[0] for m in found]
    words = np.array([hashes[w] for w in names], dtype=np.uint64)
    starts = np.array([m.start() for m in found], dtype=np.int64)
    ends = np.array([m.end() for m in found], dtype=np.int64)
    size = 64 * len(bits)
    parted = None
    for length in lengths:
        if length > len(found):
            break
        rolled = _rolled(words, length)
        places = _bits(rolled, size)
        held = ((bits[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1)).all(axis=0)
        if length > 1:
            if parted is None:
                joined = [text[a:b].isspace() for a, b in zip(ends.tolist(), starts[1:].tolist())]
                parted = np.concatenate(([0], np.cumsum(~np.array(joined, dtype=bool))))
            held &= parted[length - 1:] == parted[:len(rolled)]
        at = np.flatnonzero(held)
        first, last = starts[at].tolist(), ends[at + length - 1].tolist()
        phrases = [" ".join(names[i:i + length]) for i in at.tolist()]
        raw = [None] * len(at) if length == 1 else [
            None if text[a:b] == phrase else text[a:b] for a, b, phrase in zip(first, last, phrases)]
        yield first, last, phrases, raw


def _by_phrase(
    starts: list[int], ends: list[int], phrases: list[str], raws: list[str | None]
) -> tuple[list[str], list[list[int]], list[list[str | None] | None]]:
    """The distinct phrases of a text, the starts of each, and its texts where one differs."""
    held: dict[str, tuple[list[int], list[str | None]]] = {}
    for start, phrase, raw in zip(starts, phrases, raws, strict=True):
        own = held.get(phrase)
        if own is None:
            own = held[phrase] = ([], [])
        own[0].append(start)
        own[1].append(raw)
    return (
        list(held), [own[0] for own in held.values()],
        [own[1] if any(raw is not None for raw in own[1]) else None for own in held.values()],
    )


def dictionary_candidates(
    df: DataFrame, text: str, spans: str, dictionary: DataFrame, hot: int = HOT,
    bits: int | None = None,
) -> DataFrame:
    """Candidates joined by the phrases of the text that are in dictionary(label, word).

    A phrase is a run of words (runs of letters and digits) parted by white space; all places
    where one occurs are candidates, also overlapping ones, of which the longest is chosen later.
    A broadcast filter of bounded size names the runs that may be phrases; those, and no others,
    leave their text and meet the table, once a text with all their places.  ``df`` are numbered rows.
    """
    small_batches(df.sparkSession)
    phrases = stored(phrases_of(dictionary), "lookup_phrases")
    held, lengths = phrase_filter(phrases, bits)
    shared = df.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Memo(_hash)
        rows = Rows(
            [ROW, "phrase", "starts", "raws"],
            [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.string())])
        for batch in batches:
            for number, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with np.errstate(over="ignore"):
                    for columns in _runs_of(value or "", hashes, shared.value, lengths):
                        phrases, starts, raws = _by_phrase(*columns)
                        rows.add([number] * len(phrases), phrases, starts, raws)
                yield from rows.full()
        yield from rows.full(1)

    places = stored(
        df.select(ROW, F.col(text)).mapInArrow(
            run, f"{ROW} bigint, phrase string, starts array<int>, raws array<string>"),
        "lookup_runs",
    )
    hits = value_lookup(
        places, ["phrase"], lambda values: values.join(phrases.drop("words"), "phrase", "left"), "labels", hot,
    )
    # The value of a candidate is the text itself, whatever white space parts its words; it comes
    # along, as cutting every one out of a long text would walk that text once per candidate.
    found = hits.groupBy(ROW).agg(
        F.collect_list(F.struct("phrase", "starts", "raws", "labels")).alias("__found"))

    def candidate(start: Column, value: Column, label: Column) -> Column:
        return F.struct(
            start.alias("start"), (start + F.length(value)).alias("end"),
            F.lit(CUSTOM).alias("precedence"), label.alias("label"), value.alias("text"),
            F.lit(SCORE_PATTERN).alias("score"), F.lit(None).cast("string").alias("swap"),
        )

    def places_of(f: Column) -> Column:
        def labelled(label: Column) -> Column:
            return F.when(f["raws"].isNull(), F.transform(
                f["starts"], lambda start: candidate(start, f["phrase"], label))).otherwise(F.zip_with(
                    f["starts"], f["raws"], lambda start, raw: candidate(start, F.coalesce(raw, f["phrase"]), label)))

        return F.flatten(F.transform(f["labels"], labelled))

    met = df.join(found, ROW, "left")
    more = F.when(F.col("__found").isNull(), F.col(spans)).otherwise(
        F.concat(spans, F.flatten(F.transform("__found", places_of))))
    return met.withColumn(spans, more).select(*df.columns)
