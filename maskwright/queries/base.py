"""Registration, table access and the SQL pieces shared by the oracles."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from maskwright.functions.catalog import BUILT_INS, DETECTORS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
KEY = "maskwright"
# The built-in entity types as SQL sees them, written from their rules: label -> pattern.
_H, _V4 = "[0-9A-Fa-f]{1,4}", r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
_MONTHS = (
    r"(?:January|Jan\.?|February|Feb\.?|March|Mar\.?|April|Apr\.?|May|June?|July?|August|Aug\.?"
    r"|September|Sept\.?|Sep\.?|October|Oct\.?|November|Nov\.?|December|Dec\.?)"
)
SQL_PATTERNS = {
    "EMAIL_ADDRESS": r"[\p{L}\p{M}\p{N}._%+-]+@[\p{L}\p{M}\p{N}.-]+\.\p{L}{2,}",
    "PHONE_NUMBER": r"(?:(?:\+\d{1,3} )?\(\d{3}\) ?|\b\d{3}[-.])\d{3}[-.]\d{4}\b"
        r"|\+\d(?:[ .()-]{0,2}\d){6,}|\b0\d{2,4}[ -]\d{3,4}[ -]\d{3,4}\b"
        r"|\b0\d[ .-]\d\d[ .-]\d\d[ .-]\d\d[ .-]\d\d\b",
    # U+E010 to U+E012 stand for references of characters that end a URL, see t5_redact_html.
    "URL": r"(?:https?://|\bwww\.)[^ \t\r\n<>\"\x{E010}-\x{E012}]+",
    "IP_ADDRESS": rf"\B::(?:{_H}:){{0,5}}{_V4}\b|\b(?:{_H}:){{1,5}}:(?:{_H}:){{0,4}}{_V4}\b"
        rf"|\b(?:{_H}:){{6}}{_V4}\b|\b{_V4}\b|\b{_H}(?::{_H}){{7}}\b"
        rf"|\b(?:{_H}:){{1,6}}(?::{_H}){{1,6}}\b|\B:(?::{_H}){{1,7}}\b|\b{_H}:(?:{_H}:){{1,6}}:\B",
    "MAC_ADDRESS": r"\b[0-9A-Fa-f]{2}(?::[0-9A-Fa-f]{2}){5}\b",
    "CREDIT_CARD": r"\b(?:\d{4}[ -]?){3}\d{4}\b|\b\d{4}[ -]?\d{6}[ -]?\d{5}\b|\b[2-6]\d{12,18}\b",
    "IBAN_CODE": r"\b[A-Z]{2}\d{2}(?:[A-Z0-9]{11,}|(?: [A-Z0-9]{4}){2,}(?: [A-Z0-9]{1,3})?)\b"
        r"|\b[a-z]{2}\d{2}(?:[a-z0-9]{11,30}| [a-z0-9]{4}(?: \d[a-z0-9]{3}){1,6}(?: \d[a-z0-9]{0,2})?)\b",
    "US_SSN": r"\b\d{3}-\d{2}-\d{4}\b",
    "UUID": r"\b[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}\b",
    "SECRET_TOKEN": r"\b[0-9a-f]{32,}\b|\b[0-9A-F]{32,}\b",
    "DATE_TIME": r"\b\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?"
        r"(?: ?(?:Z|[+-]\d{2}:?\d{2}))?)?\b|\b\d{1,2}[/.]\d{1,2}[/.]\d{4}\b"
        rf"|\b\d{{1,2}}(?:st|nd|rd|th|\.)? {_MONTHS},? \d{{4}}\b"
        rf"|\b{_MONTHS} \d{{1,2}}(?:st|nd|rd|th)?,? \d{{4}}\b",
    "STREET_ADDRESS": r"\b\d{1,6}(?: [A-Z][a-z]+)+ (?:Street|St|Avenue|Ave|Road|Rd|Boulevard|Blvd"
        r"|Lane|Ln|Drive|Dr|Court|Ct|Way)\b"
        r"|\b\d{1,5}(?: bis| ter)?,? (?:rue|avenue|boulevard|place|chemin|impasse|quai)"
        r"(?: (?:des|du|de|les|le|la))*(?:[ '-][A-Z]\p{L}*)+"
        r"|\b[A-Z]\p{L}+(?:straße|strasse|weg|platz|gasse) \d{1,4}[a-z]?\b",
}


class Tables:
    """Lazy access to the tables of a folder: ``t.documents`` and so on."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    """Register a query and, where SQL can state it, the SQL of its result."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def text_literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_matches(
    source: str, key: str, text: str, label: str, pattern: str, precedence: int = 2,
    score: str = "0.9", check: str = "", where: str = "true",
) -> str:
    """SELECT of all matches of one pattern with their offsets."""
    p = text_literal(pattern)
    keep = "true"
    if check == "luhn":
        digits = "regexp_replace(m[i], '[^0-9]', '', 'g')"
        digit = f"substr(reverse({digits}), j, 1)::INT"
        valid = (
            f"list_sum(list_transform(range(1, length({digits}) + 1), lambda j: CASE WHEN j % 2 = 0 "
            f"THEN {digit} * 2 - CASE WHEN {digit} > 4 THEN 9 ELSE 0 END ELSE {digit} END)) % 10 = 0"
        )
        keep = f"({valid} OR length({digits}) = 16)"
    if check == "mod97":
        bare = "upper(replace(m[i], ' ', ''))"
        number = (
            f"list_transform(string_split(substr({bare}, 5) || substr({bare}, 1, 4), ''), lambda c: "
            f"CASE WHEN c BETWEEN '0' AND '9' THEN c::INT ELSE ord(c) - 55 END)"
        )
        valid = (
            f"list_reduce(list_concat([0], {number}), lambda a, d: "
            f"(a * CASE WHEN d > 9 THEN 100 ELSE 10 END + d) % 97) = 1"
        )
        keep = f"({valid} OR m[i] = upper(m[i]))"
    if check:
        score = f"CASE WHEN {valid} THEN 0.99 ELSE 0.9 END"
    return f"""
      SELECT k, {precedence} AS precedence, {text_literal(label)} AS label, m[i] AS text,
        ({score})::DOUBLE AS score,
        (list_sum(list_transform(g[1:i], lambda z: length(z)))
         + coalesce(list_sum(list_transform(m[1:i-1], lambda z: length(z))), 0))::INT AS "start"
      FROM (SELECT {key} AS k, regexp_extract_all({text}, {p}) AS m,
                   string_split_regex({text}, {p}) AS g FROM {source} WHERE {where}) x,
           unnest(range(1, len(m) + 1)) AS u(i) WHERE {keep}"""


def sql_candidates(
    source: str, key: str, text: str, labels: Sequence[str] | None = None,
    extra: Sequence[str] = (), name: str = "cand", where: str = "true",
) -> str:
    """CTE of candidates: built-in labels plus further SELECTs of the same shape."""
    chosen = BUILT_INS if labels is None else [DETECTORS[label] for label in labels]
    parts = [
        sql_matches(source, key, text, d.label, SQL_PATTERNS[d.label], check=d.check, where=where)
        for d in chosen
    ]
    union = "\n      UNION ALL".join([*parts, *extra])
    return f"""{name} AS (SELECT *, "start" + length(text) AS "end" FROM ({union}) q)"""


def sql_resolved(cand: str = "cand", name: str = "spans") -> str:
    """CTE of the greedy non-overlapping choice, with the ordinal per document."""
    return f"""{name} AS (
      SELECT k, c.precedence AS precedence, c.label AS label, c.text AS text,
             c.score AS score, c."start" AS "start", c."end" AS "end",
             (row_number() OVER (PARTITION BY k ORDER BY c."start") - 1)::INT AS ord
      FROM (
        SELECT k, unnest(list_reduce(
            list([{{'precedence': precedence, 'label': label, 'text': text, 'score': score,
                    'start': "start", 'end': "end"}}]
                 ORDER BY precedence, "start" - "end", "start", label),
            lambda a, x: CASE WHEN len(list_filter(a, lambda b:
                b."start" < x[1]."end" AND x[1]."start" < b."end")) > 0
              THEN a ELSE list_concat(a, x) END)) AS c
        FROM {cand} GROUP BY k) r)"""


def sql_shifted(new_text: str, spans: str = "spans", name: str = "ents") -> str:
    """CTE of spans with a new text and the offsets in the new document."""
    return f"""{name} AS (
      SELECT *, ("start" + moved)::INT AS new_start,
             ("start" + moved + length(coalesce(new_text, text)))::INT AS new_end
      FROM (
        SELECT *, coalesce(sum(length(coalesce(new_text, text)) - length(text))
            OVER (PARTITION BY k ORDER BY "start"
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS moved
        FROM (SELECT *, {new_text} AS new_text FROM {spans}) a) b)"""


def sql_rebuilt(
    source: str, key: str, text: str, ents: str = "ents", name: str = "rebuilt"
) -> str:
    """CTE (k, redacted_text, entities_found) of every document of the source."""
    return f"""{name} AS (
      SELECT d.k, coalesce(p.body, '') || substr(d.t, coalesce(p.last_end, 0) + 1) AS redacted_text,
             coalesce(p.n, 0)::INT AS entities_found
      FROM (SELECT {key} AS k, {text} AS t FROM {source}) d
      LEFT JOIN (
        SELECT k, string_agg(piece, '' ORDER BY "start") AS body, max("end") AS last_end,
               count(*) AS n
        FROM (
          SELECT e.k, e."start", e."end",
            substr(s.t, coalesce(lag(e."end") OVER w, 0) + 1,
                   e."start" - coalesce(lag(e."end") OVER w, 0))
              || coalesce(e.new_text, e.text) AS piece
          FROM {ents} e JOIN (SELECT {key} AS k, {text} AS t FROM {source}) s ON s.k = e.k
          WINDOW w AS (PARTITION BY e.k ORDER BY e."start")) q
        GROUP BY k) p ON p.k = d.k)"""


# --- surrogates -----------------------------------------------------------------------------

REDACTED = "'[' || label || ']'"


def sql_hash(label: str = "label", value: str = "text") -> str:
    return f"('0x' || substr(sha256('{KEY}|' || {label} || '|' || {value}), 1, 15))::UBIGINT"


def sql_scramble(label: str = "label", value: str = "text") -> str:
    byte = (
        f"('0x' || substr(sha256('{KEY}|' || {label} || '|' || {value} || '#' || "
        f"((i - 1) // 32)::VARCHAR), ((i - 1) % 32 * 2 + 1)::BIGINT, 2))::INT"
    )
    ch = f"substr({value}, i::BIGINT, 1)"
    return (
        f"array_to_string(list_transform(range(1, length({value}) + 1), lambda i: "
        f"CASE WHEN regexp_full_match({ch}, '[0-9]') THEN ({byte} % 10)::VARCHAR "
        f"WHEN regexp_full_match({ch}, '[a-z]') THEN chr({byte} % 26 + 97) "
        f"WHEN regexp_full_match({ch}, '[A-Z]') THEN chr({byte} % 26 + 65) "
        f"ELSE {ch} END), '')"
    )


def sql_pool(values: Sequence[str], h: str) -> str:
    items = ", ".join(text_literal(v) for v in values)
    return f"([{items}])[({h} % {len(values)} + 1)::BIGINT]"


def sql_generator(generator: str, label: str = "label", value: str = "text") -> str:
    from maskwright.functions.catalog import FAMILY_NAMES, GIVEN_NAMES, ORGANIZATIONS

    h = sql_hash(label, value)
    if generator == "Scramble":
        return sql_scramble(label, value)
    if generator == "Email":
        return f"'user' || ({h})::VARCHAR || '@example.com'"
    if generator == "PhoneNumber":
        return (
            f"'(' || ({h} % 800 + 200)::VARCHAR || ') 555-01' || "
            f"lpad((({h} // 1000) % 100)::VARCHAR, 2, '0')"
        )
    if generator == "Ssn":
        return (
            f"({h} % 100 + 900)::VARCHAR || '-' || lpad((({h} // 100) % 100)::VARCHAR, 2, '0') "
            f"|| '-' || lpad((({h} // 10000) % 10000)::VARCHAR, 4, '0')"
        )
    if generator == "IpAddress":
        return (
            f"'10.' || ({h} % 256)::VARCHAR || '.' || (({h} // 256) % 256)::VARCHAR || '.' "
            f"|| (({h} // 65536) % 256)::VARCHAR"
        )
    if generator == "Url":
        return f"'https://example.com/' || ({h})::VARCHAR"
    if generator == "CreditCard":
        payload = f"'4' || lpad(({h} % 100000000000000)::VARCHAR, 14, '0')"
        digit = f"substr({payload}, j::BIGINT, 1)::INT"
        total = (
            f"list_sum(list_transform(range(1, 16), lambda j: CASE WHEN j % 2 = 1 THEN "
            f"{digit} * 2 - CASE WHEN {digit} > 4 THEN 9 ELSE 0 END ELSE {digit} END))"
        )
        return f"{payload} || ((10 - {total} % 10) % 10)::BIGINT::VARCHAR"
    if generator == "DateTime":
        day = f"try_strptime(substr({value}, 1, 10), '%Y-%m-%d')"
        return (
            f"CASE WHEN {day} IS NOT NULL THEN "
            f"strftime({day}::DATE + (({h} % 61)::INT - 30), '%Y-%m-%d') || substr({value}, 11) "
            f"ELSE {sql_scramble(label, value)} END"
        )
    if generator == "Name":
        given, family = sql_pool(GIVEN_NAMES, h), sql_pool(FAMILY_NAMES, f"({h} // 1000)")
        return (
            f"CASE {label} WHEN 'NAME_GIVEN' THEN {given} WHEN 'NAME_FAMILY' THEN {family} "
            f"ELSE {given} || ' ' || {family} END"
        )
    if generator == "Organization":
        return sql_pool(ORGANIZATIONS, h)
    raise ValueError(generator)


def sql_synthesis(labels: Sequence[str] | None = None, value: str = "text") -> str:
    """Default surrogate of every built-in label."""
    chosen = BUILT_INS if labels is None else [DETECTORS[label] for label in labels]
    whens = " ".join(
        f"WHEN '{d.label}' THEN {sql_generator(d.generator, 'label', value)}" for d in chosen
    )
    return f"CASE label {whens} END"


def sql_canonical(value: str = "text") -> str:
    bare = rf"lower(regexp_replace({value}, '[^\p{{L}}\p{{N}}]', '', 'g'))"
    return f"CASE WHEN {bare} = '' THEN {value} ELSE {bare} END"


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select
