"""Span algebra on arrays, all JVM-side.

A *candidate* is a struct (start, end, precedence, label, text, score, swap); an *entity* is the
public struct of :data:`ENTITY_TYPE`.  ``swap`` is the replacement a swap table names for
the value, NULL otherwise.  Offsets are 0-based code points, half open.
Everything here is a plain Column expression, so it can be used in a projection, inside a
lambda over leaves of a structured document, in a batch job or in a stream.

Cost: nothing is quadratic in the number of spans of a row beyond ``BLOCK`` of them.  Running totals
work on blocks, overlaps are resolved cluster by cluster and texts are spliced region by region.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.functions.catalog import BUILT_IN, SCORE_CHECKED, SCORE_PATTERN, Detector

CANDIDATE_TYPE = (
    "struct<start:int,end:int,precedence:int,label:string,text:string,score:double,swap:string>"
)
ENTITY_TYPE = (
    "struct<start:int,end:int,new_start:int,new_end:int,label:string,text:string,"
    "new_text:string,score:double,language:string>"
)
BLOCK = 64
# Parts the pieces of a text around its matches, see ``Pattern.pieces``.
_CUT = "\x01"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(value: Column) -> Column:
    """Keep the optimizer from copying an expensive value into later filters.

    A filter on a computed column, also the one that ``explode`` implies, is moved below the
    projection and takes the whole expression with it, once per reference.  A projection that
    is not deterministic stays where it is.  Filters on other columns belong before it.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def empty_candidates() -> Column:
    return F.array().cast(f"array<{CANDIDATE_TYPE}>")


def running(values: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Inclusive running fold of an array in near-linear time.

    ``step`` must be associative with ``start`` as its neutral element.
    """

    def fold(part: Column) -> Column:
        return F.aggregate(part, start, step)

    def prefix(part: Column, base: Column) -> Column:
        # One pass over the block, each step growing the array of totals.
        grown = F.aggregate(
            part, F.array(base), lambda acc, x: F.concat(
                acc, F.array(step(F.get(acc, F.size(acc) - 1), x))
            )
        )
        return F.slice(grown, F.lit(2), F.size(part))

    def join(blocks: Column) -> Column:
        return let(
            F.transform(blocks, fold),
            lambda sums: F.flatten(
                F.transform(
                    blocks, lambda part, i: prefix(part, fold(F.slice(sums, F.lit(1), i)))
                )
            ),
        )

    def cut(arr: Column) -> Column:
        last = F.greatest(F.ceil(F.size(arr) / BLOCK), F.lit(1)).cast("int") - 1
        return F.transform(
            F.sequence(F.lit(0), last), lambda b: F.slice(arr, b * BLOCK + 1, F.lit(BLOCK))
        )

    return let(values, lambda arr: F.when(F.size(arr) <= BLOCK, prefix(arr, start)).otherwise(
        let(cut(arr), join)))


def running_sum(values: Column) -> Column:
    return running(values, F.lit(0), lambda a, b: a + b)


def running_max(values: Column) -> Column:
    return running(values, F.lit(0), lambda a, b: F.greatest(a, b))


def locate(matches: Column, gaps: Column) -> Column:
    """Start offsets of the matches, from the matches and the pieces between them."""

    def starts(m: Column) -> Column:
        widths = F.zip_with(
            F.slice(gaps, F.lit(1), F.size(m)), m, lambda g, x: F.length(g) + F.length(x)
        )
        return F.zip_with(running_sum(widths), m, lambda e, x: e - F.length(x))

    return let(matches, starts)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn_valid(value: Column) -> Column:
    return F.call_function("luhn_check", digits_of(value))


def mod97_valid(value: Column) -> Column:
    """Whether an IBAN's check digits fit: letters count as 10 to 35, the first four come last."""

    def step(rest: Column, ch: Column) -> Column:
        return F.when(
            ch.between("0", "9"), (rest * 10 + F.ascii(ch) - 48) % 97
        ).otherwise((rest * 100 + F.ascii(ch) - 55) % 97)

    def by_character(bare: Column) -> Column:
        turned = F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))
        return F.aggregate(F.split(turned, ""), F.lit(0), lambda rest, ch: F.when(ch == "", rest).otherwise(
            step(rest, ch))) == 1

    def at_once(bare: Column) -> Column:
        # Digits after the country's two letters: one number of at most 38 digits.
        letters = [(F.ascii(F.substring(bare, i, 1)) - 55).cast("string") for i in (1, 2)]
        number = F.concat(
            F.substring(bare, F.lit(5), F.length(bare)), *letters, F.substring(bare, 3, 2))
        return number.cast("decimal(38,0)") % F.lit(97).cast("decimal(38,0)") == 1

    bare = F.replace(value, F.lit(" "), F.lit(""))
    return F.when(F.rlike(bare, F.lit("^[A-Z]{2}[0-9]{4,34}\\z")), at_once(bare)).otherwise(
        by_character(F.upper(bare)))


@dataclass(frozen=True)
class Pattern:
    """One regular expression to search for, with what its matches mean.

    ``once`` is set for those that never match the empty string: one search of a text finds both
    the matches and the pieces between them.  ``search`` is the same pattern as this search has it,
    and what it passes from one match to the next, see ``catalog.Detector``.
    """

    regex: str
    label: str
    precedence: int
    score: float = SCORE_PATTERN
    check: str = ""
    gate: Callable[[Column], Column | None] | None = None
    once: bool = False
    search: tuple[str, str] | None = None

    def matches(self, text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(self.regex), F.lit(0))

    def pieces(self, text: Column, also: Column | None = None) -> Column:
        """The pieces of a text in turn: gap, match, gap, match, ...; NULL where the gate says
        that there is no match."""
        gaps = F.split(text, self.regex, -1)
        cut = F.flatten(F.zip_with(gaps, self.matches(text), lambda gap, match: F.array(gap, match)))
        if self.once:
            regex, passed = self.search or (self.regex, "")
            if passed:
                marked = F.regexp_replace(
                    text, rf"\G((?:{passed})*+)({regex})", f"$1{_CUT}$2{_CUT}")
            else:
                marked = F.regexp_replace(text, regex, f"{_CUT}$0{_CUT}")
            cut = F.when(F.contains(text, F.lit(_CUT)), cut).otherwise(F.split(marked, _CUT, -1))
        test = also
        own = None if self.gate is None else self.gate(text)
        if own is not None:
            test = own if test is None else test & own
        return cut if test is None else F.when(test, cut)

    def group(self, pieces: Column) -> Column:
        return F.struct(
            F.lit(self.label).alias("label"),
            F.lit(self.precedence).alias("precedence"),
            F.lit(self.score).cast("double").alias("score"),
            F.lit(self.check).alias("check"),
            pieces.alias("pieces"),
        )


def built_in_patterns(detectors: Sequence[Detector]) -> list[Pattern]:
    return [
        Pattern(d.pattern, d.label, BUILT_IN, check=d.check, gate=d.hint_column, once=True,
                search=d.search())
        for d in detectors
    ]


def _placed(pieces: Column, build: Callable[[Column, Column], Column]) -> Column:
    """What ``build`` makes of the start and the value of every match among the pieces."""
    matches = F.filter(pieces, lambda p, i: (i % 2 == 1) & p.isNotNull())
    gaps = F.filter(pieces, lambda _, i: i % 2 == 0)
    alone = F.array(build(F.length(F.get(pieces, F.lit(0))), F.get(pieces, F.lit(1))))
    return F.when(F.size(pieces) <= 4, alone).otherwise(
        F.zip_with(locate(matches, gaps), matches, build))


def _candidate(
    start: Column, value: Column, label: Column, precedence: Column, score: Column
) -> Column:
    return F.struct(
        start.alias("start"),
        (start + F.length(value)).alias("end"),
        precedence.alias("precedence"),
        label.alias("label"),
        value.alias("text"),
        score.alias("score"),
        F.lit(None).cast("string").alias("swap"),
    )


def _score(value: Column, check: Column, score: Column) -> Column:
    """The score of a value with a checksum, NULL for one that is no candidate."""
    valid = F.when(check == "luhn", luhn_valid(value)).otherwise(mod97_valid(value))
    strict = F.when(check == "luhn", F.length(digits_of(value)) == 16).otherwise(
        value == F.upper(value))
    return F.when(valid, F.lit(SCORE_CHECKED)).when(strict, score)


def candidates(groups: Sequence[Column]) -> Column:
    """Candidates of several patterns from the pieces that they cut a text into."""
    return candidates_of(F.array(*groups))


def candidates_of(groups: Column) -> Column:
    """Candidates of an array of groups, see ``Pattern.group``.

    A valid checksum raises the score.  Without one, card numbers of other than 16 digits and
    IBANs in small letters are no candidates.
    """

    def place(g: Column) -> Column:
        def build(start: Column, value: Column, score: Column) -> Column:
            return _candidate(start, value, g["label"], g["precedence"], score)

        def checked(start: Column, value: Column) -> Column:
            return build(start, value, _score(value, g["check"], g["score"]))

        def plain(start: Column, value: Column) -> Column:
            return build(start, value, g["score"])

        return F.when(g["check"] == "", _placed(g["pieces"], plain)).otherwise(
            F.filter(_placed(g["pieces"], checked), lambda c: c["score"].isNotNull()))

    hit = F.filter(groups, lambda g: F.size(g["pieces"]) > 2)
    return F.flatten(F.transform(hit, place))


def with_pattern_candidates(
    df: DataFrame, text: Column, patterns: Sequence[Pattern], also: Sequence[Column | None], out: str
) -> DataFrame:
    """Add the candidates of several patterns, each searched where its ``also`` holds.

    Lambdas are interpreted, other expressions are compiled: patterns are searched in a projection
    of their own, and a single match, the usual case, needs no lambda.
    """
    keep = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
    slots = [F.col(f"__m{i}") for i in range(len(patterns))]
    found = df.select(*keep, *[
        once(p.pieces(text, test)).alias(f"__m{i}") for i, (p, test) in enumerate(zip(patterns, also))])
    single = [(F.size(m) > 2) & (F.size(m) <= 4) for m in slots]
    value = [F.get(m, F.lit(1)) for m in slots]
    scores = [
        F.when(one, _score(v, F.lit(p.check), F.lit(p.score).cast("double")) if p.check else F.lit(p.score).cast("double"))
        for p, one, v in zip(patterns, single, value)]
    groups = [F.when(F.size(m) > 4, p.group(m)) for p, m in zip(patterns, slots)]
    many = [F.size(m) > 4 for m in slots]
    staged = found.select(
        *keep, *slots, *[once(s).alias(f"__s{i}") for i, s in enumerate(scores)],
        once(F.when(reduce(Column.__or__, many), F.array(*groups))).alias("__groups"),
    )
    parts = [
        F.when(F.col(f"__s{i}").isNotNull(), F.array(_candidate(
            F.length(F.get(m, F.lit(0))), v, F.lit(p.label), F.lit(p.precedence), F.col(f"__s{i}"))))
        .otherwise(empty_candidates())
        for i, (p, m, v) in enumerate(zip(patterns, slots, value))]
    rest = F.when(F.col("__groups").isNotNull(), candidates_of(F.col("__groups"))).otherwise(empty_candidates())
    return staged.select(*keep, once(F.concat(*parts, rest)).alias(out))


def pattern_candidates(text: Column, patterns: Sequence[Pattern]) -> Column:
    """Candidates of several patterns in one expression, for use inside lambdas."""
    if not patterns:
        return empty_candidates()
    return F.coalesce(
        candidates([p.group(p.pieces(text)) for p in patterns]), empty_candidates())


def _keep_best(cluster: Column) -> Column:
    """Greedy choice within one cluster of overlapping candidates."""
    ranked = F.sort_array(
        F.transform(
            cluster,
            lambda c: F.struct(
                c["precedence"].alias("p"),
                (c["start"] - c["end"]).alias("neg_len"),
                c["start"].alias("s"),
                c["label"].alias("l"),
                c.alias("c"),
            ),
        )
    )
    kept = F.aggregate(
        F.transform(ranked, lambda r: r["c"]),
        empty_candidates(),
        lambda acc, c: F.when(
            F.exists(acc, lambda k: (k["start"] < c["end"]) & (c["start"] < k["end"])), acc
        ).otherwise(F.concat(acc, F.array(c))),
    )
    return F.sort_array(kept)


def resolve(cands: Column) -> Column:
    """Non-overlapping choice by (precedence, longest, leftmost, label), sorted by start."""

    def clustered(arr: Column) -> Column:
        reach = running_max(F.transform(arr, lambda c: c["end"]))

        def cut(r: Column) -> Column:
            heads = F.filter(
                F.sequence(F.lit(1), F.size(arr)),
                lambda i: (i == 1) | (F.get(arr, i - 1)["start"] >= F.get(r, i - 2)),
            )

            def split(h: Column) -> Column:
                clusters = F.transform(
                    h,
                    lambda b, j: F.slice(
                        arr, b, F.coalesce(F.get(h, j + 1), F.size(arr) + 1) - b
                    ),
                )
                return F.flatten(
                    F.transform(
                        clusters, lambda c: F.when(F.size(c) == 1, c).otherwise(_keep_best(c))
                    )
                )

            return let(heads, split)

        return let(reach, cut)

    def few(arr: Column) -> Column:
        return F.when(F.size(arr) <= 1, arr).when(F.size(arr) <= BLOCK, _keep_best(arr)).otherwise(
            let(F.sort_array(arr), many))

    def many(arr: Column) -> Column:
        return F.when(apart(arr), arr).otherwise(clustered(arr))

    def apart(arr: Column) -> Column:
        # Every one ends before the next starts, so each is a cluster of its own.
        following = F.zip_with(
            F.slice(arr, F.lit(1), F.size(arr) - 1), F.slice(arr, F.lit(2), F.size(arr) - 1),
            lambda a, b: (a["start"] <= a["end"]) & (a["end"] <= b["start"]),
        )
        return F.forall(following, lambda x: x)

    return let(cands, few)


def with_new_text(spans: Column, replacement: Callable[[Column], Column]) -> Column:
    """Pairs of a candidate and its new text; NULL means "left as it is"."""
    return F.transform(
        spans, lambda c: F.struct(c.alias("c"), replacement(c).alias("new_text"))
    )


def entities_of(paired: Column, language: Column) -> Column:
    """Resolved candidates with their new texts -> entities with offsets in the new text."""

    def shift(pairs: Column) -> Column:
        growth = F.transform(
            pairs,
            lambda p: F.length(F.coalesce(p["new_text"], p["c"]["text"]))
            - (p["c"]["end"] - p["c"]["start"]),
        )
        return F.zip_with(
            pairs,
            F.zip_with(running_sum(growth), growth, lambda total, own: total - own),
            lambda p, moved: F.struct(
                p["c"]["start"].alias("start"),
                p["c"]["end"].alias("end"),
                (p["c"]["start"] + moved).alias("new_start"),
                (
                    p["c"]["start"]
                    + moved
                    + F.length(F.coalesce(p["new_text"], p["c"]["text"]))
                ).alias("new_end"),
                p["c"]["label"].alias("label"),
                p["c"]["text"].alias("text"),
                p["new_text"].alias("new_text"),
                p["c"]["score"].alias("score"),
                language.cast("string").alias("language"),
            ),
        )

    return F.when(
        F.size(paired) > 0, let(paired, shift)
    ).otherwise(F.array().cast(f"array<{ENTITY_TYPE}>"))


def to_entities(spans: Column, replacement: Callable[[Column], Column], language: Column) -> Column:
    """Resolved candidates -> entities with replacement text and offsets in the new text.

    ``replacement`` maps a candidate to its new text, NULL meaning "left as it is".
    """
    return let(with_new_text(spans, replacement), lambda pairs: entities_of(pairs, language))


def splice(text: Column, edits: Column) -> Column:
    """Replace ``edits`` (sorted structs start, end, value) in ``text``.

    Works on regions of BLOCK edits, so a long text is not walked once per edit.
    """

    def pieces(region: Column, offset: Column, part: Column) -> Column:
        return F.array_join(
            F.transform(
                part,
                lambda e, i: let(
                    F.when(i == 0, offset).otherwise(F.get(part, i - 1)["end"]),
                    lambda prev: F.concat(
                        F.substring(region, prev - offset + 1, e["start"] - prev), e["value"]
                    ),
                ),
            ),
            "",
        )

    def build(arr: Column) -> Column:
        n = F.size(arr)
        regions = F.transform(
            F.sequence(F.lit(0), F.ceil(n / BLOCK).cast("int") - 1),
            lambda b: let(
                F.when(b == 0, F.lit(0)).otherwise(F.get(arr, b * BLOCK - 1)["end"]),
                lambda offset: let(
                    F.slice(arr, b * BLOCK + 1, F.lit(BLOCK)),
                    lambda part: let(
                        F.substring(
                            text, offset + 1, F.get(part, F.size(part) - 1)["end"] - offset
                        ),
                        lambda region: pieces(region, offset, part),
                    ),
                ),
            ),
        )
        tail = F.get(arr, n - 1)["end"]
        return F.concat(
            F.when(n <= BLOCK, pieces(text, F.lit(0), arr)).otherwise(F.array_join(regions, "")),
            F.substring(text, tail + 1, F.length(text) - tail),
        )

    return F.when(F.size(edits) > 0, let(edits, build)).otherwise(text)


def apply_entities(text: Column, entities: Column) -> Column:
    """The redacted text: every entity with a replacement is spliced in."""
    edits = F.transform(
        F.filter(entities, lambda e: e["new_text"].isNotNull()),
        lambda e: F.struct(
            e["start"].alias("start"), e["end"].alias("end"), e["new_text"].alias("value")
        ),
    )
    return splice(text, edits)


def word_count(text: Column) -> Column:
    """Whitespace-separated words, the usage figure of a text."""
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
