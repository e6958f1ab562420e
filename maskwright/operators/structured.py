"""Redaction inside JSON, XML and HTML columns: values change, structure does not.

The leaves of a document stay an array of its row.  They are detected, transformed and spliced
back by raw offsets, so unchanged parts keep their bytes (key order, spacing, number text).
A malformed document becomes an error row without text.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.functions import spans as sp
from maskwright.functions.catalog import ALLOW, SCORE_FORCED
from maskwright.functions.jsonpath import to_regex
from maskwright.operators.policy import RedactOptions
from maskwright.operators.redact import _name, text_spans
from maskwright.operators.sizing import small_batches
from maskwright.sources.walkers import json_leaves_udf, xml_leaves_udf

# What parts a tag's pieces, and elements whose content is code, or text.
_GAP, _AFTER_NAME = r"[\t\n\f\r ]*+", r"(?=[\t\n\f\r />])"
_CODE, _TEXT = "script|style", "title|textarea|xmp|iframe|noembed|noframes"


def _attributes(end: str) -> str:
    """What follows a tag's name: names, and values in quotes, without quotes or missing.

    ``end`` is what closes a quote that nothing closes.
    """
    value = (
        rf"(?:\"[^\"]*+(?:\"{end})|'[^']*+(?:'{end})|[^\t\n\f\r >\"'][^\t\n\f\r >]*+|(?=>){end})"
    )
    name = r"[^\t\n\f\r />][^\t\n\f\r />=]*+"
    return rf"(?:[\t\n\f\r /]++|{name}(?:{_GAP}={_GAP}{value}|(?!{_GAP}=)))*+"


def _markup(end: str) -> dict[str, str]:
    """The forms of markup as the tokeniser of the HTML standard reads them.

    ``end`` closes what nothing else does.  Every repeat is possessive or lazy over single
    characters, so a text is read in linear time and without recursion.
    """
    closing = rf"{_attributes(end)}(?:>{end})"
    return {
        "comment": rf"<!--(?:-?>|.*?(?:--!?>{end}))",
        "code": rf"<(?<code>{_CODE}){_AFTER_NAME}{_attributes('')}>"
                rf".*?(?:</\k<code>{_AFTER_NAME}{closing}{end})",
        "tag": rf"</?[A-Za-z][^\t\n\f\r />]*+{closing}",
        "bogus": rf"<(?:!(?!--)|\?)[^>]*+(?:>{end})|</(?![A-Za-z])[^>]*+(?:>{end})",
    }


_OPEN_TEXT = rf"<(?<text>{_TEXT}){_AFTER_NAME}{_attributes('')}>"
_FORMS = _markup(r"|\z")
# Where a text element opens, its content comes in the same token, and is cut off later.
HTML_TOKEN = (
    rf"(?is){_FORMS['comment']}|{_FORMS['code']}"
    rf"|{_OPEN_TEXT}.*?(?=</\k<text>{_AFTER_NAME}|\z)"
    rf"|{_FORMS['tag']}|{_FORMS['bogus']}|(?:[^<]++|<(?![A-Za-z/!?]))++"
)
# (A tag that opens code is closed with its code only.)
_FORMS = _markup("")
_CLOSED = (
    rf"(?is)^(?:{_FORMS['comment']}|{_FORMS['code']}|(?!<(?:{_CODE}){_AFTER_NAME}){_FORMS['tag']}"
    rf"|{_FORMS['bogus']})\z"
)
_HTML_REFERENCE = r"&(?:[A-Za-z][A-Za-z0-9]*|#[0-9]+|#[xX][0-9A-Fa-f]+);"
# Named character references that are decoded in text content.
HTML_ENTITIES = {
    "&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ",
}
# All named references of HTML, from the standard library.
ALL_HTML_ENTITIES = {f"&{name}": value for name, value in html5.items() if name.endswith(";")}


def json_encode(value: Column) -> Column:
    """A JSON string literal with its quotes."""
    wrapped = F.to_json(F.struct(value.alias("v")))
    return F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)


def xml_encode(value: Column, kind: Column) -> Column:
    escaped = F.replace(
        F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
        F.lit(">"), F.lit("&gt;"),
    )
    return (
        F.when(kind == "cdata", F.replace(value, F.lit("]]>"), F.lit("]]]]><![CDATA[>")))
        .when(kind == "attribute", F.replace(escaped, F.lit('"'), F.lit("&quot;")))
        .when(kind == "quoted attribute", F.replace(escaped, F.lit("'"), F.lit("&apos;")))
        .otherwise(escaped)
    )


def html_encode(value: Column) -> Column:
    return xml_encode(value, F.lit("text"))


def _code_point(number: Column) -> Column:
    """The character of a code point; no character for numbers beyond Unicode."""
    valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    return F.when(
        valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    )


def html_pieces(token: Column) -> Column:
    """The references of a text run and the pieces between them; joined, they are the run."""
    pattern = F.lit(_HTML_REFERENCE + "|[^&]+|&")
    return F.when(
        F.contains(token, F.lit("&")), F.regexp_extract_all(token, pattern, F.lit(0))
    ).otherwise(F.array(token))


def _decoded(piece: Column) -> Column:
    """A character reference resolved; unknown ones and other pieces stay as they are."""
    def table(names: dict[str, str]) -> Column:
        # One constant, however many names.
        return F.from_json(F.lit(json.dumps(names)), "map<string,string>")

    # Leading zeros do not count; more digits than Unicode has are no character.
    number = F.when(
        F.rlike(piece, F.lit("^&#0*[0-9]{1,7};$")),
        F.regexp_extract(piece, "^&#0*([0-9]{1,7});$", 1).try_cast("int"),
    ).when(
        F.rlike(piece, F.lit("^&#[xX]0*[0-9A-Fa-f]{1,6};$")),
        F.conv(F.regexp_extract(piece, "^&#[xX]0*([0-9A-Fa-f]{1,6});$", 1), 16, 10)
        .try_cast("int"),
    )
    named = F.coalesce(
        F.try_element_at(table(HTML_ENTITIES), piece),
        F.try_element_at(table(ALL_HTML_ENTITIES), piece),
    )
    return F.when(
        F.startswith(piece, F.lit("&#")), F.coalesce(_code_point(number), piece)
    ).when(
        F.startswith(piece, F.lit("&")) & (F.length(piece) > 1), F.coalesce(named, piece)
    ).otherwise(piece)


def html_decode(token: Column) -> Column:
    """Text content with its character references resolved; unknown ones stay as they are."""
    return F.when(
        F.contains(token, F.lit("&")), F.array_join(F.transform(html_pieces(token), _decoded), "")
    ).otherwise(token)


def _raw_offset(pieces: Column, offset: Column) -> Column:
    """Where an offset of the decoded text lies in the raw run.

    ``pieces`` are structs (raw, value) of lengths.  Pieces that end at or before the offset
    count whole; of a piece that contains it, the characters before it.
    """
    start = F.struct(F.lit(0).alias("raw"), F.lit(0).alias("value"))
    return F.aggregate(
        pieces, start,
        lambda at, p: F.when(
            at["value"] + p["value"] <= offset,
            F.struct((at["raw"] + p["raw"]).alias("raw"), (at["value"] + p["value"]).alias("value")),
        ).when(
            at["value"] < offset,
            F.struct((at["raw"] + offset - at["value"]).alias("raw"), offset.alias("value")),
        ).otherwise(at),
        lambda at: at["raw"],
    )


def html_spliced(token: Column, entities: Column) -> Column:
    """A raw text run with its entities replaced and every other byte as it was."""
    changed = F.filter(entities, lambda e: e["new_text"].isNotNull())

    def edits(sizes: Column) -> Column:
        return F.transform(
            changed,
            lambda e: F.struct(
                _raw_offset(sizes, e["start"]).alias("start"),
                _raw_offset(sizes, e["end"]).alias("end"),
                html_encode(e["new_text"]).alias("value"),
            ),
        )

    sizes = F.transform(
        html_pieces(token),
        lambda p: F.struct(F.length(p).alias("raw"), F.length(_decoded(p)).alias("value")),
    )
    return F.when(
        F.size(changed) > 0, sp.let(sp.let(sizes, edits), lambda e: sp.splice(token, e))
    ).otherwise(token)


def _leaf_entities(
    value: Column,
    options: RedactOptions,
    language: Column,
    forced: Callable[[Column], Column] | None = None,
) -> Column:
    spans = text_spans(value, options)
    if forced is not None:
        spans = sp.let(
            forced(value),
            lambda extra: F.when(F.size(extra) > 0, extra).otherwise(spans),
        )
    return sp.let(spans, lambda s: sp.to_entities(s, options.replacement(), language))


def _finish(
    df: DataFrame,
    columns: Sequence[str],
    text: Column,
    path_name: str,
    encode: Callable[[Column, Column], Column],
    out: str,
) -> DataFrame:
    """From ``__leaves`` with entities to the rebuilt text and the document's entities."""
    changed = F.filter(
        F.col("__leaves"), lambda l: F.exists(l["entities"], lambda e: e["new_text"].isNotNull())
    )
    edits = F.transform(
        changed,
        lambda l: F.struct(
            l["start"].alias("start"),
            l["end"].alias("end"),
            encode(sp.apply_entities(l["value"], l["entities"]), l["kind"]).alias("value"),
        ),
    )
    entities = F.flatten(
        F.transform(
            F.col("__leaves"),
            lambda l: F.transform(
                l["entities"],
                lambda e: F.struct(
                    *[e[f].alias(f) for f in _ENTITY_FIELDS], l["path"].alias(path_name)
                ),
            ),
        )
    )
    keep = [_name(c) for c in columns]
    rebuilt = df.select(
        *keep, F.col("__error"), sp.once(edits).alias("__edits"), entities.alias("entities")
    )
    bad = F.col("__error").isNotNull()
    return rebuilt.select(
        *keep,
        F.when(~bad, sp.splice(text, F.col("__edits"))).alias(out),
        F.col("entities"),
        F.coalesce(F.size("entities"), F.lit(0)).alias("entities_found"),
        F.when(bad, "error").otherwise("success").alias("status"),
        F.col("__error").alias("error"),
    )


_ENTITY_FIELDS = (
    "start", "end", "new_start", "new_end", "label", "text", "new_text", "score", "language",
)


def json_leaf_table(df: DataFrame, id_cols: Sequence[str], json_col: str) -> DataFrame:
    """One row per string leaf: path and decoded value, with raw offsets."""
    small_batches(df.sparkSession)
    walked = df.select(*[_name(c) for c in id_cols], json_leaves_udf(_name(json_col)).alias("w"))
    return walked.select(*[_name(c) for c in id_cols], F.inline("w.leaves"))


def xml_leaf_table(df: DataFrame, id_cols: Sequence[str], xml_col: str) -> DataFrame:
    """One row per attribute value, text and CDATA section."""
    small_batches(df.sparkSession)
    walked = df.select(*[_name(c) for c in id_cols], xml_leaves_udf(_name(xml_col)).alias("w"))
    return walked.select(*[_name(c) for c in id_cols], F.inline("w.leaves"))


def any_path(path: Column, patterns: Sequence[str]) -> Column:
    test = F.lit(False)
    for pattern in patterns:
        test = test | F.rlike(path, F.lit(to_regex(pattern)))
    return test


def redact_json(
    df: DataFrame,
    json_col: str,
    options: RedactOptions = RedactOptions(),
    *,
    path_allow_lists: Mapping[str, Sequence[str]] | None = None,
    path_ignore: Sequence[str] = (),
    language_col: str | None = None,
    out: str = "redacted_text",
) -> DataFrame:
    """Redact string values of a JSON column.

    Values at ``path_ignore`` stay as they are; values at an allow path become one span of its
    label.  Ignore beats allow.
    """
    text, language = _name(json_col), _name(language_col) if language_col else F.lit(None)
    keep = [_name(c) for c in df.columns]
    ignored = [to_regex(p) for p in path_ignore]
    allowed = [(label, to_regex(p)) for label, ps in (path_allow_lists or {}).items() for p in ps]

    def forced(path: Column) -> Callable[[Column], Column] | None:
        if not allowed:
            return None

        def whole(value: Column) -> Column:
            label = F.lit(None).cast("string")
            for name, regex in reversed(allowed):
                label = F.when(F.rlike(path, F.lit(regex)), name).otherwise(label)
            return sp.let(
                label,
                lambda found: F.when(
                    found.isNotNull() & (F.length(value) > 0),
                    F.array(
                        F.struct(
                            F.lit(0).alias("start"),
                            F.length(value).alias("end"),
                            F.lit(ALLOW).alias("precedence"),
                            found.alias("label"),
                            value.alias("text"),
                            F.lit(SCORE_FORCED).alias("score"),
                            F.lit(None).cast("string").alias("swap"),
                        )
                    ),
                ).otherwise(sp.empty_candidates()),
            )

        return whole

    def leaf(l: Column) -> Column:
        entities = _leaf_entities(l["value"], options, language, forced(l["path"]))
        if ignored:
            skip = F.lit(False)
            for regex in ignored:
                skip = skip | F.rlike(l["path"], F.lit(regex))
            entities = F.when(
                skip, F.array().cast(f"array<{sp.ENTITY_TYPE}>")
            ).otherwise(entities)
        return F.struct(
            *[l[f].alias(f) for f in ("kind", "path", "start", "end", "value")],
            entities.alias("entities"),
        )

    small_batches(df.sparkSession)
    walked = df.select(*keep, json_leaves_udf(text).alias("__w"))
    leaves = walked.select(
        *keep,
        F.col("__w.error").alias("__error"),
        sp.once(F.transform(F.col("__w.leaves"), leaf)).alias("__leaves"),
    )
    return _finish(leaves, df.columns, text, "json_path", lambda v, _: json_encode(v), out)


def redact_xml(
    df: DataFrame,
    xml_col: str,
    options: RedactOptions = RedactOptions(),
    *,
    language_col: str | None = None,
    out: str = "redacted_text",
) -> DataFrame:
    """Redact text and attribute values of an XML column."""
    text, language = _name(xml_col), _name(language_col) if language_col else F.lit(None)
    keep = [_name(c) for c in df.columns]
    small_batches(df.sparkSession)
    walked = df.select(*keep, xml_leaves_udf(text).alias("__w"))
    leaves = walked.select(
        *keep,
        F.col("__w.error").alias("__error"),
        sp.once(
            F.transform(
                F.col("__w.leaves"),
                lambda l: F.struct(
                    *[l[f].alias(f) for f in ("kind", "path", "start", "end", "value")],
                    _leaf_entities(l["value"], options, language).alias("entities"),
                ),
            )
        ).alias("__leaves"),
    )
    return _finish(leaves, df.columns, text, "xml_path", xml_encode, out)


def html_tokens(html: Column) -> Column:
    """Markup and text runs as structs (raw, is_text); the raw parts joined are the input.

    Tags, comments, scripts and styles are markup, as the HTML standard reads them: a quoted
    ``>`` does not end a tag, a ``<`` that opens nothing is text, and so is the content of titles
    and text areas.  Markup that nothing closes before the text ends is taken for text.
    """
    def kinds(tokens: Column) -> Column:
        def cut(token: Column, i: Column) -> Column:
            markup = F.rlike(token, F.lit("^<[A-Za-z/!?]"))
            unclosed = (i == F.size(tokens) - 1) & ~F.rlike(token, F.lit(_CLOSED))
            head = F.regexp_extract(token, f"(?is)^{_OPEN_TEXT}", 0)
            parts = F.array(
                F.struct(head.alias("raw"), F.lit(False).alias("is_text")),
                F.struct(F.substring(token, F.length(head) + 1, F.length(token)).alias("raw"),
                         F.lit(True).alias("is_text")),
            )
            opens_text = markup & F.rlike(token, F.lit(f"(?i)^<(?:{_TEXT})[\t\n\f\r />]")) & (head != "")
            return F.when(opens_text, F.filter(parts, lambda p: p["raw"] != "")).otherwise(
                F.array(F.struct(token.alias("raw"), (~markup | unclosed).alias("is_text"))))

        return F.flatten(F.transform(tokens, cut))

    return sp.let(F.regexp_extract_all(html, F.lit(HTML_TOKEN), F.lit(0)), kinds)


def html_token_table(df: DataFrame, id_cols: Sequence[str], html_col: str) -> DataFrame:
    """Text runs of an HTML column with their decoded content."""
    keys = [_name(c) for c in id_cols]
    return (
        df.select(*keys, sp.once(html_tokens(_name(html_col))).alias("__tokens"))
        .select(*keys, F.posexplode("__tokens").alias("ord", "__token"))
        .filter("__token.is_text")
        .select(*keys, "ord", F.col("__token.raw").alias("token"),
                html_decode(F.col("__token.raw")).alias("value"))
    )


def redact_html(
    df: DataFrame,
    html_col: str,
    options: RedactOptions = RedactOptions(),
    *,
    language_col: str | None = None,
    out: str = "redacted_text",
) -> DataFrame:
    """Redact the text content of an HTML column; tags, comments and scripts stay untouched.

    Entity offsets count in the decoded text run named by ``token``.
    """
    text, language = _name(html_col), _name(language_col) if language_col else F.lit(None)
    keep = [_name(c) for c in df.columns]
    tokens = df.select(*keep, sp.once(html_tokens(text)).alias("__tokens"))

    def run(token: Column, i: Column) -> Column:
        return sp.let(
            html_decode(token["raw"]),
            lambda value: F.struct(
                i.alias("token"),
                token["raw"].alias("raw"),
                value.alias("value"),
                F.when(
                    ~token["is_text"],
                    F.array().cast(f"array<{sp.ENTITY_TYPE}>"),
                ).otherwise(_leaf_entities(value, options, language)).alias("entities"),
            ),
        )

    runs = tokens.select(*keep, sp.once(F.transform(F.col("__tokens"), run)).alias("__runs"))
    rebuilt = F.array_join(
        F.transform(
            F.col("__runs"),
            lambda r: html_spliced(r["raw"], r["entities"]),
        ),
        "",
    )
    entities = F.flatten(
        F.transform(
            F.col("__runs"),
            lambda r: F.transform(
                r["entities"],
                lambda e: F.struct(
                    *[e[f].alias(f) for f in _ENTITY_FIELDS], r["token"].alias("token")
                ),
            ),
        )
    )
    return runs.select(
        *keep,
        rebuilt.alias(out),
        F.coalesce(entities, F.array().cast(f"array<{sp.ENTITY_TYPE[:-1]},token:int>>")).alias(
            "entities"
        ),
        F.coalesce(F.size(entities), F.lit(0)).alias("entities_found"),
        F.lit("success").alias("status"),
        F.lit(None).cast("string").alias("error"),
    )
