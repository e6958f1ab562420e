"""The options of a redaction job, checked when the plan is built."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from maskwright.functions import generators as gen
from maskwright.functions.catalog import (
    DEFAULT_GENERATOR,
    DETECTORS,
    GENERATOR_VERSIONS,
    HANDLINGS,
    SYNTHESIS_HANDLINGS,
)


@dataclass(frozen=True)
class LabelList:
    """Literal strings and regular expressions listed for one entity type."""

    strings: Sequence[str] = ()
    regexes: Sequence[str] = ()


@dataclass(frozen=True)
class GeneratorMetadata:
    """How surrogates of one entity type are made."""

    version: str = "V1"
    custom_generator: str | None = None
    swaps: Mapping[str, str] = field(default_factory=dict)


def _check_pattern(pattern: str) -> None:
    if pattern == "":
        raise ValueError("a list pattern must not be empty")
    try:
        compiled = re.compile(pattern)
    except re.error:
        return  # Java syntax that Python does not know; Spark reports what it cannot compile
    if any(m.group() == "" for probe in ("", "a1 .") for m in compiled.finditer(probe)):
        raise ValueError(f"a list pattern must not match the empty string: {pattern!r}")


@dataclass(frozen=True)
class RedactOptions:
    """Per-entity-type policy of a redaction job.

    ``labels`` restricts the built-in detectors that are put into the plan, ``key`` seeds all
    surrogates (the kinds of Synthesis need one) and ``replacements`` holds the user's pools for
    ReplacementSynthesis; large pools and swaps are passed to ``redact`` as tables.
    """

    generator_config: Mapping[str, str] = field(default_factory=dict)
    generator_default: str | None = None
    generator_metadata: Mapping[str, GeneratorMetadata] = field(default_factory=dict)
    custom_entities: Sequence[str] = ()
    label_block_lists: Mapping[str, LabelList] = field(default_factory=dict)
    label_allow_lists: Mapping[str, LabelList] = field(default_factory=dict)
    labels: Sequence[str] | None = None
    key: str | None = None
    replacements: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        handlings = [*self.generator_config.values()]
        if self.generator_default is not None:
            handlings.append(self.generator_default)
        for handling in handlings:
            if handling not in HANDLINGS:
                raise ValueError(
                    f"unknown handling {handling!r}; known: {', '.join(HANDLINGS)}"
                )
        for label, meta in self.generator_metadata.items():
            if meta.version not in GENERATOR_VERSIONS:
                raise ValueError(f"unknown generator version {meta.version!r} for {label}")
            if meta.custom_generator is not None and meta.custom_generator not in gen.GENERATORS:
                raise ValueError(
                    f"unknown generator {meta.custom_generator!r}; "
                    f"known: {', '.join(gen.GENERATORS)}"
                )
        for label in self.labels or ():
            if label not in DETECTORS:
                raise ValueError(f"no built-in detector for {label!r}")
        for lists in (self.label_block_lists, self.label_allow_lists):
            for entry in lists.values():
                if "" in entry.strings:
                    raise ValueError("a listed string must not be empty")
                for pattern in entry.regexes:
                    _check_pattern(pattern)
        if self.key is None and set(handlings) & set(SYNTHESIS_HANDLINGS):
            raise ValueError("surrogates need a key of your own: without a secret key they can be "
                             "tried out")

    def surrogate_key(self) -> str:
        if self.key is None:
            raise ValueError("surrogates need a key")
        return self.key

    def handling_of(self, label: str) -> str:
        return self.generator_config.get(label, self.generator_default or "Redaction")

    def _plan_of(self, label: str) -> tuple[str, str, str]:
        meta = self.generator_metadata.get(label, GeneratorMetadata())
        generator = meta.custom_generator or DEFAULT_GENERATOR.get(label, "Scramble")
        if meta.version == "V2":
            generator = "Scramble"
        return self.handling_of(label), meta.version, generator

    def known_labels(self) -> list[str]:
        return sorted(
            {
                *DEFAULT_GENERATOR,
                *self.generator_config,
                *self.generator_metadata,
                *self.label_allow_lists,
                *self.replacements,
            }
        )

    def replacement(self) -> Callable[[Column], Column]:
        """Candidate -> new text, NULL under ``Off``."""
        groups: dict[tuple[str, str, str], list[str]] = {}
        for label in self.known_labels():
            groups.setdefault(self._plan_of(label), []).append(label)
        fallback = self._plan_of("")

        def new_text(c: Column) -> Column:
            label = c["label"]
            out = None
            for (handling, _, generator), labels in groups.items():
                if (handling, _, generator) == fallback:
                    continue
                made = self._make(handling, generator, c)
                test = label.isin(*labels)
                out = F.when(test, made) if out is None else out.when(test, made)
            rest = self._make(fallback[0], fallback[2], c)
            return rest if out is None else out.otherwise(rest)

        return new_text

    def _make(self, handling: str, generator: str, c: Column) -> Column:
        label, value = c["label"], c["text"]
        if handling == "Off":
            return F.lit(None).cast("string")
        if handling == "Redaction":
            return gen.redaction(label)
        seed = gen.canonical(value) if handling == "GroupingSynthesis" else value
        made = self._generate(handling, generator, label, value, seed)
        return F.coalesce(c["swap"], self._inline_swap(label, value), made)

    def _generate(
        self, handling: str, generator: str, label: Column, value: Column, seed: Column
    ) -> Column:
        if handling == "GroupingSynthesis" and generator == "DateTime":
            made = gen.let(
                gen.keyed_hash(self.key, label, seed),
                lambda h: gen.date_time(self.key, label, value, h),
            )
        else:
            made = gen.generate(generator, self.key, label, value) if seed is value else gen.let(
                seed, lambda s: gen.generate(generator, self.key, label, s))
        if handling != "ReplacementSynthesis" or not self.replacements:
            return made
        drawn = None
        for name, pool in sorted(self.replacements.items()):
            if not pool:
                continue
            pick = F.get(
                F.array(*[F.lit(p) for p in pool]),
                (gen.keyed_hash(self.key, label, value) % len(pool)).cast("int"),
            )
            drawn = F.when(label == name, pick) if drawn is None else drawn.when(label == name, pick)
        return made if drawn is None else F.coalesce(drawn.otherwise(F.lit(None)), made)

    def _inline_swap(self, label: Column, value: Column) -> Column:
        swap = F.lit(None).cast("string")
        for name, meta in self.generator_metadata.items():
            if meta.swaps:
                table = F.create_map(*[F.lit(x) for pair in meta.swaps.items() for x in pair])
                swap = F.when(label == name, F.try_element_at(table, value)).otherwise(swap)
        return swap

    def is_blocked(self, c: Column) -> Column:
        """Whether a built-in or custom candidate is on its block list."""
        blocked = F.lit(False)
        for name, entry in self.label_block_lists.items():
            hit = F.lit(False)
            if entry.strings:
                hit = hit | c["text"].isin(*entry.strings)
            for pattern in entry.regexes:
                hit = hit | F.rlike(c["text"], F.lit(pattern))
            blocked = blocked | ((c["label"] == name) & hit)
        return blocked
