"""The catalogue of built-in entity types.

Every detector is a Java regular expression.  Repeats of values that can be long have no upper
bound, so such a value is found whole.  A search starts only where a run of its characters starts
(or where the last match ended), so that one long token cannot make matching quadratic.  Only
single characters, groups of one length and possessive groups are repeated without a bound: the
engine loops over those, where it would call itself for others and overflow the stack.

Each pattern carries a *gate*, a test that every match of the pattern implies.  A gate that is a
pattern costs as much as the search does, so searches are spared by literals (``hints``) only.
Some patterns name what a search may *pass*: runs of characters none of which starts a match, which
are left behind at once, where the engine would try the pattern at every character.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HANDLINGS = ("Redaction", "Synthesis", "GroupingSynthesis", "ReplacementSynthesis", "Off")
SYNTHESIS_HANDLINGS = ("Synthesis", "GroupingSynthesis", "ReplacementSynthesis")
GENERATOR_VERSIONS = ("V1", "V2")

# Precedence of a candidate span by origin; the lowest wins an overlap.
ALLOW, CUSTOM, BUILT_IN = 0, 1, 2

SCORE_FORCED = 1.0
SCORE_CHECKED = 0.99
SCORE_PATTERN = 0.9


_CLASSES = re.compile(r"\\.|\[((?:[^\]\\]|\\.)+)\]")


def listed(pattern: str) -> str:
    """A pattern with the characters of its ASCII classes listed one by one.

    The engine looks listed characters up in one table.  It calls a function for each range, two for
    what is not in a range, and a search is slow where many kinds of them meet.
    """

    def one(m: re.Match) -> str:
        body = {r"\d": "0-9", r"\w": "0-9A-Z_a-z"}.get(m[0], m[1])
        if body is None or body[0] == "^" or re.search(r"\\[^x]|\\x{", body):
            return m[0]
        return "[" + "".join(
            chr(code) if code < 128 and chr(code).isalnum() else rf"\x{code:02x}"
            for code in range(256) if re.match(f"[{body}]", chr(code))) + "]"

    return _CLASSES.sub(one, pattern)


@dataclass(frozen=True)
class Detector:
    """One entity type found by a regular expression."""

    label: str
    family: str
    pattern: str
    gate: str
    gate_is_literal: bool = False
    generator: str = "Scramble"
    # Checksum of the values: "luhn", "mod97" or none.  It raises the score; values of the loose
    # forms (see ``spans.candidates``) are dropped without it.
    check: str = ""
    # Where a match can start: one of ``starts``, which are written as in a character class.  What
    # a search passes at such a place, if no match starts there, is ``passed``; by default the rest
    # of the word.  ``likely`` is a cheap test that every match implies where it starts.  Where it is
    # None, ``passed`` says itself what is passed from one match to the next.
    starts: str = ""
    passed: str = r"\w+"
    likely: str | None = ""
    # Literals of which every match holds one; none: every text is searched.
    hints: tuple[str, ...] = ()

    def search(self) -> tuple[str, str]:
        """The pattern as it is searched for, and what the search passes between matches."""
        if not self.starts:
            return listed(self.pattern), ""
        found = f"(?!{self.likely}{self.pattern})"
        if self.likely is None:
            return listed(self.pattern), listed(self.passed)
        others = "".join(
            f"\\x{code:02x}" for code in range(256) if not re.match(f"[{self.starts}]", chr(code)))
        return listed(self.pattern), listed(
            rf"[{others}]+|{found}(?>{self.passed})|[\x{{100}}-\x{{10ffff}}]+")

    def hint_column(self, text: Column) -> Column | None:
        held = [F.contains(text, F.lit(hint)) for hint in self.hints]
        return reduce(Column.__or__, held) if held else None

    def gate_column(self, text: Column) -> Column:
        if self.gate_is_literal:
            return F.contains(text, F.lit(self.gate))
        return F.rlike(text, F.lit(self.gate))


_WORDLIKE = r"\p{L}\p{M}\p{N}"
_MAIL = rf"{_WORDLIKE}._%+-"
_HEX4 = "[0-9A-Fa-f]{1,4}"
_IPV4 = r"\d{1,3}(?:\.\d{1,3}){3}"
_MONTH = (
    r"(?:Jan(?:uary|\.)?|Feb(?:ruary|\.)?|Mar(?:ch|\.)?|Apr(?:il|\.)?|May|June?|July?"
    r"|Aug(?:ust|\.)?|Sept?(?:ember|\.)?|Oct(?:ober|\.)?|Nov(?:ember|\.)?|Dec(?:ember|\.)?)"
)
_ROAD = (
    "(?:Street|St|Avenue|Ave|Road|Rd|Boulevard|Blvd|Lane|Ln|Drive|Dr|Court|Ct|Way)"
)
# Capitalised words that do not end an address, then one that does.
_TO_ROAD = rf"(?:(?!{_ROAD}\b)[A-Z][a-z]++ )*+{_ROAD}\b"


# Label, family, pattern, gate, default generator.
BUILT_INS: tuple[Detector, ...] = (
    Detector(
        "EMAIL_ADDRESS", "contact",
        r"(?:\G|(?<![\p{L}\p{M}\p{N}._%+-]))[\p{L}\p{M}\p{N}._%+-]++@"
        r"[\p{L}\p{M}\p{N}.-]+\.\p{L}{2,}",
        "@", gate_is_literal=True, generator="Email", hints=("@",),
        starts=_MAIL, likely=None,
        passed=rf"(?>(?:[0-9A-Za-z._%+-]+|[{_WORDLIKE}]+)++)(?!@[{_WORDLIKE}.-]+\.\p{{L}}{{2,}})|[^{_MAIL}]",
    ),
    Detector(
        "PHONE_NUMBER", "contact",
        r"(?=[+(0-9])(?:(?:(?:\+\d{1,3} )?\(\d{3}\) ?|\b\d{3}[-.])\d{3}[-.]\d{4}\b"
        r"|\+\d(?:[ .()-]{0,2}\d){6,}+"
        r"|\b0\d(?:\d{1,3}[ -]\d{3,4}[ -]\d{3,4}|(?:[ .-]\d{2}){4})\b)",
        r"\d{3}[-.]\d{4}|\+\d|0\d{1,4}[ .-]\d\d", generator="PhoneNumber",
        starts="+(0-9", passed=r"\w+|[+(]",
    ),
    Detector(
        "URL", "network", r"(?:https?://|\bwww\.)[^ \t\r\n<>\"]+",
        r"://|www\.", generator="Url", hints=("://", "www."), starts="hw", passed="[hw]",
    ),
    Detector(
        "IP_ADDRESS", "network",
        rf"(?=[0-9A-Fa-f]|::)(?:\B::(?:{_HEX4}:){{0,5}}{_IPV4}\b|\b(?:(?=[0-9A-Fa-f]{{0,4}}:)"
        rf"(?:(?:{_HEX4}:){{1,5}}:(?:{_HEX4}:){{0,4}}{_IPV4}\b|(?:{_HEX4}:){{6}}{_IPV4}\b"
        rf"|(?:{_HEX4}:){{7}}{_HEX4}\b|(?:{_HEX4}:){{1,6}}(?::{_HEX4}){{1,6}}\b"
        rf"|(?:{_HEX4}:){{2,7}}:\B)|{_IPV4}\b)|\B::(?:{_HEX4}:){{0,6}}{_HEX4}\b)",
        r"\d\.\d{1,3}\.\d|[0-9A-Fa-f]:[0-9A-Fa-f]{0,4}:|::[0-9A-Fa-f]", generator="IpAddress",
        starts=":0-9A-Fa-f", passed=r"\w+|:", likely=r"(?=[0-9A-Fa-f]{0,4}:|\d{1,3}\.)",
    ),
    Detector(
        "MAC_ADDRESS", "network", r"\b(?:[0-9A-Fa-f]{2}:){5}[0-9A-Fa-f]{2}\b",
        r"[0-9A-Fa-f]{2}:[0-9A-Fa-f]{2}:", hints=(":",),
    ),
    Detector(
        "CREDIT_CARD", "financial",
        r"\b\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}\b|\b\d{4}[ -]?\d{6}[ -]?\d{5}\b|\b[2-6]\d{12,18}\b",
        r"\d{4}[ -]?\d{4}", generator="CreditCard", check="luhn",
        starts="0-9",
    ),
    Detector(
        "IBAN_CODE", "financial",
        r"\b(?:[A-Z]{2}\d{2}(?:[A-Z0-9]{11,}|(?: [A-Z0-9]{4}){2,}(?: [A-Z0-9]{1,3})?)"
        r"|[a-z]{2}\d{2}(?:[a-z0-9]{11,30}| [a-z0-9]{4}(?: \d[a-z0-9]{3}){1,6}(?: \d[a-z0-9]{0,2})?))\b",
        r"[A-Z]{2}\d{2} ?[A-Z0-9]|[a-z]{2}\d{2} ?[a-z0-9]", check="mod97",
    ),
    Detector(
        "US_SSN", "government", r"\b\d{3}-\d{2}-\d{4}\b",
        r"\d-\d{2}-\d", generator="Ssn", hints=("-",), starts="0-9",
    ),
    Detector(
        "UUID", "secret",
        r"\b[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\b",
        r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-", hints=("-",),
    ),
    Detector(
        "SECRET_TOKEN", "secret", r"\b(?:[0-9a-f]{32,}|[0-9A-F]{32,})\b",
        r"[0-9a-f]{16}|[0-9A-F]{16}",
    ),
    Detector(
        "DATE_TIME", "time",
        r"(?=[0-9JFMASOND])\b(?:\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?(?: ?(?:Z|[+-]\d{2}:?\d{2}))?)?\b"
        r"|\d{1,2}[/.]\d{1,2}[/.]\d{4}\b"
        rf"|\d{{1,2}}(?:st|nd|rd|th|\.)? {_MONTH},? \d{{4}}\b"
        rf"|{_MONTH} \d{{1,2}}(?:st|nd|rd|th)?,? \d{{4}}\b)",
        r"\d{4}-\d{2}-\d{2}|\d[/.]\d{1,2}[/.]\d{4}"
        r"|(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*+[.,]*+ \d",
        generator="DateTime", starts="0-9JFMASOND",
        likely=r"(?=\d{4}-|\d{1,2}[a-z/. ]|[JFMASOND][aepuco])",
    ),
    Detector(
        "STREET_ADDRESS", "contact",
        rf"(?=[0-9A-Z])\b(?:\d{{1,6}} [A-Z][a-z]++ {_TO_ROAD}(?: {_TO_ROAD})*+"
        r"|\d{1,5}(?: bis| ter)?,? (?:rue|avenue|boulevard|place|chemin|impasse|quai)"
        r"(?: (?:des|du|de|les|le|la))*+(?:[ '-][A-Z]\p{L}*+)++"
        r"|[A-Z]\p{L}++(?<=\p{L}\p{L}(?:straße|strasse|weg|platz|gasse)) \d{1,4}[a-z]?\b)",
        r"\d [A-Z][a-z]+ |\d (?:bis,? |ter,? )?(?:rue|ave|bou|pla|che|imp|qua)"
        r"|\d, (?:rue|ave|bou|pla|che|imp|qua)|(?:e|eg|tz) \d",
        starts="0-9A-Z", likely=r"\b(?=\d++,? |[A-Z]\p{L}++ \d)",
    ),
)

# Implied by every built-in pattern: each needs a digit, '@', ':', 'www.' or eight hex letters.
ANY_BUILT_IN_GATE = r"[0-9@:]|[A-Fa-f]{8}|www\."

# Entity types without a pattern of their own: found by dictionary, list or trained model.
LISTED_TYPES: tuple[tuple[str, str, str], ...] = (
    ("NAME_GIVEN", "person", "Name"),
    ("NAME_FAMILY", "person", "Name"),
    ("ORGANIZATION", "organization", "Organization"),
)

DETECTORS = {d.label: d for d in BUILT_INS}
DEFAULT_GENERATOR = {d.label: d.generator for d in BUILT_INS} | {
    label: generator for label, _, generator in LISTED_TYPES
}

# Pools of surrogate names, drawn from by keyed hash.
GIVEN_NAMES = (
    "Alma", "Basil", "Carla", "Dario", "Edith", "Felix", "Greta", "Hugo", "Irene", "Jonas",
    "Klara", "Leon", "Mira", "Nils", "Olga", "Pavel", "Quinn", "Rosa", "Silas", "Thea",
    "Ulric", "Vera", "Wanda", "Yusuf",
)
FAMILY_NAMES = (
    "Abbott", "Barlow", "Carver", "Dalton", "Ellery", "Foster", "Garner", "Hadley", "Ingram",
    "Jarvis", "Keller", "Lawson", "Mercer", "Norris", "Osborn", "Porter", "Quincy", "Rowley",
    "Sawyer", "Turner", "Upton", "Vernon", "Warner", "Yates",
)
ORGANIZATIONS = (
    "Amber Works", "Birch Trading", "Cobalt Partners", "Delta Mills", "Ember Logistics",
    "Fjord Systems", "Granite Supply", "Harbor Foods", "Indigo Labs", "Juniper Motors",
    "Keystone Optics", "Lumen Textiles", "Meridian Rail", "Northway Media", "Opal Chemicals",
    "Pioneer Glass",
)

# Routes and media types of the file kinds the folder job knows.
FILE_TYPES: tuple[tuple[str, str, str], ...] = (
    (".txt", "text/plain", "text"),
    (".json", "application/json", "json"),
    (".html", "text/html", "html"),
    (".htm", "text/html", "html"),
    (".xml", "application/xml", "xml"),
    (".csv", "text/csv", "csv"),
    (".tsv", "text/tab-separated-values", "csv"),
    (".pdf", "application/pdf", "binary"),
    (".docx", "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "binary"),
    (".xlsx", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", "binary"),
    (".png", "image/png", "binary"),
    (".jpg", "image/jpeg", "binary"),
    (".jpeg", "image/jpeg", "binary"),
)
# Media types of files that are listed but never routed.
OTHER_MEDIA_TYPES: tuple[tuple[str, str], ...] = (
    (".log", "text/plain"),
    (".tif", "image/tiff"),
    (".tiff", "image/tiff"),
    (".md", "text/markdown"),
)


def pii_types() -> list[str]:
    """Names of all entity types, detected by pattern or by list."""
    return sorted(DEFAULT_GENERATOR)


def catalog(spark: SparkSession) -> DataFrame:
    """The catalogue as a table: one row per entity type."""
    rows = [
        (d.label, d.family, d.pattern, d.gate, BUILT_IN, d.generator) for d in BUILT_INS
    ] + [(label, family, None, None, CUSTOM, gen) for label, family, gen in LISTED_TYPES]
    return spark.createDataFrame(
        rows,
        "label string, family string, pattern string, gate string, precedence int, "
        "default_generator string",
    )
