"""Paths, durations, clipping and other scalar helpers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from maskwright.functions.catalog import FILE_TYPES, OTHER_MEDIA_TYPES

CLIP_LENGTH = 1000


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def dir_name(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]+/*$", 1)


def extension(name: Column) -> Column:
    """Extension with its dot; a leading dot alone starts no extension."""
    return F.regexp_extract(name, r"^.+(\.[^.]*)$", 1)


def relative_path(path: Column, root: Column) -> Column:
    base = F.concat(F.rtrim(root, F.lit("/")), F.lit("/"))
    return F.when(F.startswith(path, base), F.substring(path, F.length(base) + 1, F.length(path)))


def media_type(name: Column) -> Column:
    """Media type by extension, ``unknown`` when there is none."""
    known: Mapping[str, str] = {ext: mime for ext, mime, _ in FILE_TYPES} | dict(OTHER_MEDIA_TYPES)
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.lower(extension(name))), F.lit("unknown"))


def _div(number: Column, by: int) -> Column:
    return F.call_function("div", number, F.lit(by))


def duration_seconds(text: Column) -> Column:
    """Seconds of ``30m``, ``1h``, ``7d``, ``45s`` or ``[d.]HH:mm:ss``; NULL when neither."""
    short = r"(?i)^(\d+)\s*([smhd])$"
    clock = r"^(?:(\d+)\.)?(\d+):(\d{2}):(\d{2})$"
    unit = F.lower(F.regexp_extract(text, short, 2))
    factor = (
        F.when(unit == "s", 1).when(unit == "m", 60).when(unit == "h", 3600).otherwise(86400)
    )

    def part(group: int) -> Column:
        return F.coalesce(F.regexp_extract(text, clock, group).try_cast("long"), F.lit(0))

    return F.when(
        text.rlike(short), F.regexp_extract(text, short, 1).try_cast("long") * factor
    ).when(text.rlike(clock), part(1) * 86400 + part(2) * 3600 + part(3) * 60 + part(4))


def duration_clock(seconds: Column) -> Column:
    """``HH:mm:ss`` below a day, ``d.HH:mm:ss`` from a day on."""

    def two(value: Column) -> Column:
        return F.lpad(value.cast("string"), 2, "0")

    days = _div(seconds, 86400)
    clock = F.concat_ws(
        ":",
        two(_div(seconds % 86400, 3600)),
        two(_div(seconds % 3600, 60)),
        two(seconds % 60),
    )
    return F.when(days > 0, F.concat(days.cast("string"), F.lit("."), clock)).otherwise(clock)


def normalize_duration(text: Column) -> Column:
    """Short forms become clock form; anything else passes through."""
    return F.when(
        text.rlike(r"(?i)^\d+\s*[smhd]$"), duration_clock(duration_seconds(text))
    ).otherwise(text)


def clip(text: Column, limit: int = CLIP_LENGTH) -> Column:
    """Long values are shortened for the audit table, with their full length noted."""
    return F.when(
        F.length(text) > limit,
        F.concat(
            F.substring(text, 1, limit),
            F.lit("... ("),
            F.length(text).cast("string"),
            F.lit(" chars)"),
        ),
    ).otherwise(text)


def clip_array(values: Column) -> Column:
    return F.concat(F.lit("[Array("), F.size(values).cast("string"), F.lit(")]"))


def error_message(payload: Column, fallback: Column) -> Column:
    """First non-empty of message, detail and title of a JSON error payload."""

    def field(name: str) -> Column:
        return F.nullif(F.get_json_object(payload, f"$.{name}"), F.lit(""))

    return F.coalesce(field("message"), field("detail"), field("title"), fallback)
