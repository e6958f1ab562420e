"""Redaction of a text column: detect, resolve, transform, rebuild.

With inline policies the whole job is a chain of projections: no shuffle, no Python.  Tables
of swaps, blocked values, replacements or phrases meet the values of the candidates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from maskwright.functions import spans as sp
from maskwright.functions.catalog import (
    ALLOW,
    ANY_BUILT_IN_GATE,
    BUILT_INS,
    CUSTOM,
    DETECTORS,
    SCORE_FORCED,
    SCORE_PATTERN,
    Detector,
)
from maskwright.functions.jsonpath import literal
from maskwright.operators import lookups, pattern_tables
from maskwright.operators.detectors import detector
from maskwright.operators.policy import RedactOptions
from maskwright.operators.sizing import lookup_join, small_batches
from maskwright.operators.words import word_places

CANDIDATES = "__candidates"


def _name(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def refuse_clashes(df: DataFrame, outputs: Sequence[str]) -> None:
    """A table that has a column of an output's name already is refused."""
    taken = {c.lower() for c in df.columns}
    clashes = [name for name in outputs if name.lower() in taken]
    if clashes:
        raise ValueError(f"the table has columns of the outputs' names: {', '.join(clashes)}")


def enabled(options: RedactOptions) -> list[Detector]:
    if options.labels is None:
        return list(BUILT_INS)
    return [DETECTORS[label] for label in options.labels]


def listed_patterns(options: RedactOptions) -> list[sp.Pattern]:
    """Patterns of the allow lists: every occurrence is forced to the label."""
    patterns = []
    for label, entry in options.label_allow_lists.items():
        for value in entry.strings:
            patterns.append(
                sp.Pattern(
                    literal(value), label, ALLOW, SCORE_FORCED,
                    gate=lambda text, value=value: F.contains(text, F.lit(value)),
                )
            )
        for regex in entry.regexes:
            patterns.append(sp.Pattern(regex, label, ALLOW, SCORE_FORCED))
    return patterns


def custom_candidates(text: Column, options: RedactOptions) -> list[Column]:
    return [detector(entity_id)(text) for entity_id in options.custom_entities]


def _unblocked(cands: Column, options: RedactOptions) -> Column:
    if not options.label_block_lists:
        return cands
    return F.filter(
        cands, lambda c: (c["precedence"] == ALLOW) | ~options.is_blocked(c)
    )


def text_spans(text: Column, options: RedactOptions) -> Column:
    """Resolved candidates of a text as one expression, for use inside lambdas."""
    built_in = F.when(
        F.rlike(text, F.lit(ANY_BUILT_IN_GATE)),
        sp.pattern_candidates(text, sp.built_in_patterns(enabled(options))),
    ).otherwise(sp.empty_candidates())
    parts = [built_in, *custom_candidates(text, options)]
    if options.label_allow_lists:
        parts.append(sp.pattern_candidates(text, listed_patterns(options)))
    return sp.resolve(_unblocked(F.concat(*parts), options))


def with_candidates(df: DataFrame, text_col: str, options: RedactOptions) -> DataFrame:
    """All candidates of every text, before overlaps are resolved.

    Staged projections, so that each regular expression is evaluated once per row and only
    for rows that hold a literal it needs.
    """
    text, keep = _name(text_col), [_name(c) for c in df.columns]
    patterns = sp.built_in_patterns(enabled(options))
    hot = [F.col("__hot")] * len(patterns)
    listed = listed_patterns(options)
    parts = custom_candidates(text, options)
    found = df.select(*keep, F.rlike(text, F.lit(ANY_BUILT_IN_GATE)).alias("__hot"))
    if patterns or listed:
        found = sp.with_pattern_candidates(
            found, text, [*patterns, *listed], [*hot, *[None] * len(listed)], "__found")
        parts.append(F.col("__found"))
    cands = F.coalesce(F.concat(*parts), sp.empty_candidates()) if parts else sp.empty_candidates()
    return found.select(*keep, sp.once(_unblocked(cands, options)).alias(CANDIDATES))


def _with_tables(
    df: DataFrame,
    text_col: str,
    options: RedactOptions,
    swaps: DataFrame | None,
    blocks: DataFrame | None,
    replacements: DataFrame | None,
    dictionary: DataFrame | None,
    allow_patterns: DataFrame | None,
    block_patterns: DataFrame | None,
) -> DataFrame:
    """Apply tables to the candidates of all rows."""
    if allow_patterns is not None:
        df = pattern_tables.forced(lookups.numbered(df), text_col, CANDIDATES, allow_patterns)
        df = df.drop(lookups.ROW)
    if dictionary is not None:
        df = lookups.dictionary_candidates(lookups.numbered(df), text_col, CANDIDATES, dictionary)
        df = df.drop(lookups.ROW)
    if block_patterns is not None:
        df = pattern_tables.unmatched(lookups.numbered(df), CANDIDATES, block_patterns)
        df = df.drop(lookups.ROW)
    if blocks is not None:
        df = lookups.unblocked(lookups.numbered(df), CANDIDATES, blocks).drop(lookups.ROW)
    if swaps is not None:
        df = lookups.swapped(lookups.numbered(df), CANDIDATES, swaps).drop(lookups.ROW)
    if replacements is not None:
        # Pools serve those labels only that are drawn from pools.
        pooled = [x for x in options.known_labels()
                  if options.handling_of(x) == "ReplacementSynthesis"]
        by_default = options.handling_of("") == "ReplacementSynthesis"
        known = F.col("label").isin(*options.known_labels())
        wanted = F.col("label").isin(*pooled) | (~known if by_default else F.lit(False))
        pools = replacements.filter(wanted)
        df = lookups.drawn(lookups.numbered(df), CANDIDATES, pools, options.surrogate_key())
        df = df.drop(lookups.ROW)
    return df


def detect(
    df: DataFrame,
    text_col: str,
    options: RedactOptions = RedactOptions(),
    *,
    swaps: DataFrame | None = None,
    blocks: DataFrame | None = None,
    replacements: DataFrame | None = None,
    dictionary: DataFrame | None = None,
    allow_patterns: DataFrame | None = None,
    block_patterns: DataFrame | None = None,
    out: str = "spans",
) -> DataFrame:
    """Add the resolved candidate spans of every text; no policy is applied yet.

    Columns go by their place meanwhile, so that their names cannot clash with others.
    """
    refuse_clashes(df, [out])
    order = df.columns
    placed = df.toDF(*[f"__c{i}" for i in range(len(order))])
    text = f"__c{order.index(text_col)}"
    found = _with_tables(
        with_candidates(placed, text, options), text, options,
        swaps, blocks, replacements, dictionary, allow_patterns, block_patterns,
    )
    return found.select(
        *[_name(c) for c in placed.columns], sp.once(sp.resolve(F.col(CANDIDATES))).alias(out)
    ).toDF(*order, out)


def transform_spans(
    df: DataFrame,
    text_col: str,
    options: RedactOptions = RedactOptions(),
    *,
    spans_col: str = "spans",
    language_col: str | None = None,
    out: str = "redacted_text",
) -> DataFrame:
    """Apply a policy to detected spans: entities, redacted text and counts.

    Detection and transformation are separate, so stored spans can be transformed again
    under another policy without another pass of the patterns.
    """
    kept = [c for c in df.columns if c != spans_col]
    refuse_clashes(df.select(*[_name(c) for c in kept]), [out, "entities", "entities_found", "usage"])
    keep = [_name(c) for c in kept]
    language = _name(language_col) if language_col else F.lit(None)
    spans = _name(spans_col)
    language = language.cast("string")
    pairs = "__pairs" + "_" * sum(c.lower().startswith("__pairs") for c in kept)
    paired = df.select(*keep, sp.once(sp.with_new_text(spans, options.replacement())).alias(pairs))
    entities = paired.select(
        *keep,
        sp.once(
            F.coalesce(
                sp.entities_of(F.col(pairs), language),
                F.array().cast(f"array<{sp.ENTITY_TYPE}>"),
            )
        ).alias("entities"),
    )
    text = _name(text_col)
    return entities.select(
        *keep,
        sp.apply_entities(text, F.col("entities")).alias(out),
        F.col("entities"),
        F.coalesce(F.size("entities"), F.lit(0)).alias("entities_found"),
        F.coalesce(sp.word_count(text), F.lit(0)).alias("usage"),
    )


def redact(
    df: DataFrame,
    text_col: str,
    options: RedactOptions = RedactOptions(),
    *,
    language_col: str | None = None,
    swaps: DataFrame | None = None,
    blocks: DataFrame | None = None,
    replacements: DataFrame | None = None,
    dictionary: DataFrame | None = None,
    allow_patterns: DataFrame | None = None,
    block_patterns: DataFrame | None = None,
    out: str = "redacted_text",
) -> DataFrame:
    """Redact a text column.

    Adds ``out``, ``entities``, ``entities_found`` and ``usage``.  Tables of any size may join in:
    ``swaps`` (label, original, replacement), ``blocks`` (label, pattern: the blocked value),
    ``replacements`` (label, position, replacement: pools of ReplacementSynthesis),
    ``dictionary`` (label, word: words or phrases), ``allow_patterns`` and ``block_patterns``
    (label, pattern: regular expressions, as Python reads them).  Values that a table allows are
    not blocked.  With tables the rows are written once, with row numbers.  A table that has a
    column of an output's name is refused.
    """
    refuse_clashes(df, [out, "entities", "entities_found", "usage"])
    spans = "__spans" + "_" * sum(c.lower().startswith("__spans") for c in df.columns)
    found = detect(
        df, text_col, options, swaps=swaps, blocks=blocks, replacements=replacements,
        dictionary=dictionary, allow_patterns=allow_patterns, block_patterns=block_patterns,
        out=spans,
    )
    return transform_spans(
        found, text_col, options, spans_col=spans, language_col=language_col, out=out
    )


def redact_array(
    df: DataFrame, texts_col: str, options: RedactOptions = RedactOptions(), **kwargs: str
) -> DataFrame:
    """Bulk form: one row per array item, with its position in ``index``."""
    kept = [c for c in df.columns if c != texts_col]
    refuse_clashes(df.select(*[_name(c) for c in kept]), ["index", "text"])
    keep = [_name(c) for c in kept]
    items = df.select(*keep, F.posexplode(_name(texts_col)).alias("index", "text"))
    return redact(items, "text", options, **kwargs)


def spans_of(df: DataFrame, keys: Sequence[str], entities_col: str = "entities") -> DataFrame:
    """The entity table: one row per entity, with its ordinal in the document."""
    return df.select(
        *[_name(k) for k in keys], F.posexplode(_name(entities_col)).alias("ord", "__e")
    ).select(*[_name(k) for k in keys], "ord", "__e.*")


def flat_candidates(df: DataFrame, keys: Sequence[str], spans_col: str = "spans") -> DataFrame:
    """One row per detected candidate, without replacement values."""
    return df.select(
        *[_name(k) for k in keys], F.posexplode(_name(spans_col)).alias("ord", "__c")
    ).select(*[_name(k) for k in keys], "ord", "__c.*").drop("swap")


def entities_per_document(
    docs: DataFrame, spans: DataFrame, key: str, out: str = "entities_found"
) -> DataFrame:
    """Counts from a stored span table, documents without spans included."""
    counts = spans.groupBy(key).agg(F.count("*").alias(out))
    return docs.select(key).join(counts, key, "left").withColumn(
        out, F.coalesce(F.col(out), F.lit(0))
    )


def dictionary_spans(
    df: DataFrame, id_col: str, text_col: str, words: DataFrame, label: str
) -> DataFrame:
    """Words of the texts that are in a dictionary table, as span rows.

    For dictionaries of any size: words(word).  Words leave their text with the id only.
    """
    small_batches(df.sparkSession)
    kept = df.select(_name(id_col).alias("id"), _name(text_col).cast("string").alias("text"))
    kinds = StructType([kept.schema["id"]]).add("start", "integer").add("word", "string")
    found = kept.mapInArrow(word_places, kinds)
    hits = lookup_join(
        found, words.select("word").distinct(), ["word"], "left_semi", ["id", "start"]
    )
    return hits.select(
        F.col("id").alias(id_col),
        F.lit(label).alias("label"),
        F.col("word").alias("text"),
        "start",
        (F.col("start") + F.length("word")).alias("end"),
        F.lit(CUSTOM).alias("precedence"),
        F.lit(SCORE_PATTERN).alias("score"),
    )
