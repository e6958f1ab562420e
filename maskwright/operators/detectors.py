"""Custom entity detectors, selected by id in ``RedactOptions.custom_entities``.

A detector maps a text column to an array of candidate structs
(:data:`maskwright.functions.spans.CANDIDATE_TYPE`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from maskwright.functions import spans as sp
from maskwright.functions.catalog import CUSTOM

DetectorFn = Callable[[Column], Column]

_REGISTERED: dict[str, DetectorFn] = {}

WORD = r"[\p{L}\p{N}]+"


def register_detector(entity_id: str, detector: DetectorFn) -> None:
    _REGISTERED[entity_id] = detector


def detector(entity_id: str) -> DetectorFn:
    if entity_id not in _REGISTERED:
        raise ValueError(f"unknown custom entity {entity_id!r}")
    return _REGISTERED[entity_id]


def pattern_detector(label: str, pattern: str) -> DetectorFn:
    """Every match of a regular expression is a span of ``label``."""
    return lambda text: sp.pattern_candidates(text, [sp.Pattern(pattern, label, CUSTOM)])


def dictionary_detector(label: str, words: Iterable[str]) -> DetectorFn:
    """Every word of the text that is in the dictionary is a span of ``label``.

    The words become part of the plan; a large dictionary is better passed to ``redact`` as a
    table.
    """
    known = sorted(set(words))
    if not known:
        raise ValueError("a dictionary must not be empty")

    def find(text: Column) -> Column:
        word = sp.Pattern(WORD, label, CUSTOM, once=True)

        def keep(pieces: Column) -> Column:
            hits = sp.candidates([word.group(pieces)])
            return F.when(
                F.exists(pieces, lambda w: w.isin(known)),
                F.filter(hits, lambda c: c["text"].isin(known)),
            ).otherwise(sp.empty_candidates())

        return F.coalesce(sp.let(word.pieces(text), keep), sp.empty_candidates())

    return find
