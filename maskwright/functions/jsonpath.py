"""JSONPath rules compiled to anchored regular expressions over leaf paths.

Leaf paths are written in one normal form: ``$``, then ``.name`` for names made of letters,
digits, ``_`` and ``-``, ``['name']`` for all others (quotes and backslashes escaped by a
backslash) and ``[i]`` for array items.
"""

from __future__ import annotations

import re

_PLAIN = re.compile(r"[A-Za-z_][A-Za-z0-9_-]*")
_STEP = re.compile(
    r"\.\.(?P<deep>[A-Za-z_][A-Za-z0-9_-]*)"
    r"|\.\*(?P<star>)"
    r"|\.(?P<name>[A-Za-z_][A-Za-z0-9_-]*)"
    r"|\[\*\](?P<any>)"
    r"|\[(?P<index>\d+)\]"
    r"|\[(?P<quote>['\"])(?P<quoted>(?:\\.|(?!(?P=quote)).)*)(?P=quote)\]"
)
_ANY_NAME = r"(?:\.[A-Za-z_][A-Za-z0-9_-]*|\['(?:\\.|[^'\\])*'\])"
_ANY_STEP = rf"(?:{_ANY_NAME}|\[\d+\])"
_SPECIAL = re.compile(r"([\\.^$|?*+()\[\]{}])")


def literal(text: str) -> str:
    return _SPECIAL.sub(r"\\\1", text)


def member_step(name: str) -> str:
    """The normal form of one object member step."""
    if _PLAIN.fullmatch(name):
        return "." + name
    return "['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"


def to_regex(path: str) -> str:
    """An anchored regex matching the path itself and everything below it."""
    if not path.startswith("$"):
        raise ValueError(f"JSONPath must start with '$': {path!r}")
    out, pos = [r"^\$"], 1
    while pos < len(path):
        step = _STEP.match(path, pos)
        if step is None:
            raise ValueError(f"unsupported JSONPath step in {path!r} at position {pos}")
        if step["deep"] is not None:
            out.append(_ANY_STEP + "*" + literal(member_step(step["deep"])))
        elif step["name"] is not None:
            out.append(literal(member_step(step["name"])))
        elif step["index"] is not None:
            out.append(rf"\[{int(step['index'])}\]")
        elif step["quoted"] is not None:
            out.append(literal(member_step(re.sub(r"\\(.)", r"\1", step["quoted"]))))
        elif step["any"] is not None:
            out.append(_ANY_STEP)
        else:
            out.append(_ANY_STEP)
        pos = step.end()
    return "".join(out) + r"(?:[.\[].*)?$"
