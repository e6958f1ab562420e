"""Tokenisers that find the text leaves of a JSON or XML document.

They only locate: for each leaf the path, the raw offsets (code points) and the decoded value.
Detection, policy and splicing stay in the JVM.  Each runs as one Arrow-batched function per
column, so no document leaves its row and nothing is shuffled.
"""

from __future__ import annotations

import json
import re
from xml.parsers import expat

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.functions.jsonpath import member_step

LEAF_TYPE = (
    T.StructType()
    .add("ord", "integer")
    .add("kind", "string")
    .add("path", "string")
    .add("start", "integer")
    .add("end", "integer")
    .add("value", "string")
)
LEAVES_TYPE = T.StructType().add("error", "string").add("leaves", T.ArrayType(LEAF_TYPE))
Leaf = tuple[int, str, str, int, int, str]

_JSON_TOKEN = re.compile(r'[ \t\r\n]*("(?:[^"\\]|\\.)*"|[{}\[\],:]|[^\s{}\[\],:"]+)')


def json_leaves(text: str) -> list[Leaf]:
    """String values of a JSON text in document order; keys and other scalars are not leaves."""
    # Numbers stay text: an integer of any length is JSON.
    json.loads(text, parse_constant=_reject_constant, parse_int=str, parse_float=str)
    leaves: list[Leaf] = []
    # One frame per open container: [kind, path of the container, current step].
    stack: list[list] = []
    expects_key = False
    for token in _JSON_TOKEN.finditer(text):
        part, start, end = token.group(1), token.start(1), token.end(1)
        here = stack[-1][1] + stack[-1][2] if stack else "$"
        if part in "{[":
            stack.append([part, here, "" if part == "{" else "[0]"])
            expects_key = part == "{"
        elif part in "}]":
            stack.pop()
            expects_key = False
        elif part == ",":
            frame = stack[-1]
            if frame[0] == "[":
                frame[2] = f"[{int(frame[2][1:-1]) + 1}]"
            expects_key = frame[0] == "{"
        elif part == ":":
            expects_key = False
        elif part[0] == '"':
            value = json.loads(part)
            value.encode()  # a lone surrogate is an error of this row, not of the batch
            if expects_key:
                stack[-1][2] = member_step(value)
            else:
                leaves.append((len(leaves), "string", here, start, end, value))
    return leaves


def _reject_constant(name: str) -> None:
    raise ValueError(f"{name} is not JSON")


_XML_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)-->"
    r"|<!\[CDATA\[(?P<cdata>.*?)\]\]>"
    r"|<\?.*?\?>"
    r"|</(?P<close>[^\s>]+)\s*>"
    r"|<(?P<open>[^\s/>!?]+)(?P<attrs>(?:\s+[^\s=]+\s*=\s*(?:\"[^\"]*\"|'[^']*'))*)\s*(?P<empty>/?)>"
    r"|(?P<text>[^<]+)",
    re.S,
)
_XML_ATTRIBUTE = re.compile(r"([^\s=]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)')", re.S)
_XML_REFERENCE = re.compile(r"&(?:#x([0-9A-Fa-f]+)|#(\d+)|(\w+));")
# The predefined entities of XML.
_XML_ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}


def _xml_decode(raw: str) -> str:
    def one(m: re.Match) -> str:
        if m[1]:
            return chr(int(m[1], 16))
        if m[2]:
            return chr(int(m[2]))
        return _XML_ENTITIES[m[3]]

    return _XML_REFERENCE.sub(one, raw) if "&" in raw else raw


def _well_formed(text: str) -> None:
    def no_doctype(*_: object) -> None:
        raise ValueError("document type declarations are not supported")

    parser = expat.ParserCreate("utf-8")
    parser.StartDoctypeDeclHandler = no_doctype
    parser.Parse(text.encode("utf-8"), True)


def xml_leaves(text: str) -> list[Leaf]:
    """Attribute values, text and CDATA of an XML text in document order."""
    _well_formed(text)
    leaves: list[Leaf] = []
    path: list[str] = []
    counts: list[dict[str, int]] = [{}]

    def add(kind: str, where: str, start: int, end: int, value: str) -> None:
        leaves.append((len(leaves), kind, where, start, end, value))

    for token in _XML_TOKEN.finditer(text):
        if token["open"] is not None:
            name = token["open"]
            counts[-1][name] = counts[-1].get(name, 0) + 1
            path.append(f"/{name}[{counts[-1][name]}]")
            counts.append({})
            here = "".join(path)
            base = token.start("attrs")
            for attr in _XML_ATTRIBUTE.finditer(token["attrs"]):
                group = 2 if attr[2] is not None else 3
                add(
                    "attribute" if group == 2 else "quoted attribute",
                    f"{here}/@{attr[1]}",
                    base + attr.start(group),
                    base + attr.end(group),
                    _xml_decode(attr[group]),
                )
            if token["empty"]:
                path.pop()
                counts.pop()
        elif token["close"] is not None:
            path.pop()
            counts.pop()
        elif token["cdata"] is not None:
            add("cdata", "".join(path), token.start("cdata"), token.end("cdata"), token["cdata"])
        elif token["text"] is not None and token["text"].strip():
            add("text", "".join(path), token.start(), token.end(), _xml_decode(token["text"]))
    return leaves


def _rows(texts: pd.Series, walk) -> pd.DataFrame:
    errors, found = [], []
    for text in texts:
        try:
            found.append([] if text is None else walk(text))
            errors.append(None)
        except (ValueError, LookupError, OverflowError, RecursionError,
                expat.ExpatError) as problem:
            found.append([])
            errors.append(f"{type(problem).__name__}: malformed document")
    return pd.DataFrame({"error": pd.Series(errors, dtype="object"), "leaves": found})


@F.pandas_udf(LEAVES_TYPE)
def json_leaves_udf(texts: pd.Series) -> pd.DataFrame:
    return _rows(texts, json_leaves)


@F.pandas_udf(LEAVES_TYPE)
def xml_leaves_udf(texts: pd.Series) -> pd.DataFrame:
    return _rows(texts, xml_leaves)


# Filters on the results must not be moved below the walk: they would walk every text again.
json_leaves_udf = json_leaves_udf.asNondeterministic()
xml_leaves_udf = xml_leaves_udf.asNondeterministic()
