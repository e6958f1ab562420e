"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns to a string.  The successive prefixes of a
conversation are rendered and neighbouring outputs compared: what output k adds to output k-1 is
the span of turn k.  A template whose output for k turns does not begin with its output for k-1
turns rewrites history; this is detected and reported with the turn where it happened.

Prefixes are rendered over the whole history: a template may look at any turn before.  A template
declared local (``template.local = True``) promises that what it adds for a turn depends on no
turn but that one and the one before; its conversations are streamed in segments of bounded
length, so one of any size needs the memory of one segment.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.llm.common import column, small_batches

# Turns of one segment of a local template: its prefixes are rendered one after another.
SEGMENT = 64
ESCAPE = "\\"
# Control strings of common chat templates.
CONTROLS = (
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]",
    "<<SYS>>", "<</SYS>>",
)
_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROLS))
_ESCAPED = re.compile(r"(?s)\\(.)")
_TURN = re.compile(r"(?s)<\|im_start\|>((?:\\.|[^\\\n])*)\n(.*?)<\|im_end\|>\n")
LOSS_ROLE = "assistant"
TURN_SCHEMA = (
    "conv_id bigint, position bigint, start bigint, end bigint, loss_start bigint, "
    "loss_end bigint, rewritten boolean, piece string"
)
SUMMARY_SCHEMA = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
    "loss_sha256 string, formatted_chars bigint"
)

Turn = tuple[str, str]
Template = Callable[[list[Turn], bool], str]


def escape(text: str) -> str:
    """Text in which no control string is left, reversibly: escape signs are doubled, and one is
    put behind the first character of every control string."""
    if "<" not in text and "[" not in text and ESCAPE not in text:
        return text
    doubled = text.replace(ESCAPE, ESCAPE * 2)
    while True:
        broken = _CONTROL.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], doubled)
        if broken == doubled:
            return broken
        doubled = broken


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def marked_turns(turns: list[Turn], open_reply: bool = False) -> str:
    """The default template: every turn between marks, under its role.

    ``open_reply`` appends the head of a reply that is still to be written.
    """
    out = [
        f"<|im_start|>{escape(role).replace(chr(10), ESCAPE + chr(10))}\n{escape(text)}<|im_end|>\n"
        for role, text in turns
    ]
    if open_reply:
        out.append(f"<|im_start|>{LOSS_ROLE}\n")
    return "".join(out)


marked_turns.local = True


def render_segment(
    turns: list[Turn], template: Template, before: list[Turn]
) -> Iterator[tuple[str, int, int, bool]]:
    """(piece, loss start, loss end, rewritten) of each turn of a segment.

    ``before`` is the last turn of the segment before (or nothing): rendered along, it shows
    whether the template rewrites history across the border.  The text under the loss lies
    between the head that the template gives an open reply and the tail that it gives an empty
    one.  Offsets count within the piece.
    """
    last = template(before, False) if before else ""
    for k, (role, text) in enumerate(turns):
        history = before + turns[:k]
        full = template(history + [(role, text)], False)
        rewritten = not full.startswith(last)
        if rewritten:
            same = next((i for i, (a, b) in enumerate(zip(full, last)) if a != b), len(full))
            piece = full[same:]
        else:
            piece = full[len(last):]
        start = end = 0
        if role == LOSS_ROLE and not rewritten:
            head = template(history, True)
            empty = template(history + [(role, "")], False)
            if head.startswith(last) and empty.startswith(head):
                start = len(head) - len(last)
                end = len(piece) - (len(empty) - len(head))
        yield piece, start, end, rewritten
        last = full


def _segments(
    batches: Iterator[pa.RecordBatch], length: int | None
) -> Iterator[tuple[int, list[Turn]]]:
    """(conv_id, turns) in order; with a length, a long conversation comes in several segments."""
    rows = (
        row for batch in batches
        for row in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True)
    )
    for conv, turns in groupby(rows, key=lambda row: row[0]):
        segment: list[Turn] = []
        for _, role, text in turns:
            segment.append((role, text))
            if len(segment) == length:
                yield conv, segment
                segment = []
        if segment:
            yield conv, segment


def format_turns(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    template: Template = marked_turns,
    segment: int | None = None,
) -> DataFrame:
    """One row per turn: its piece of the formatted conversation, its span [start, end) there,
    the span of its text under the loss (empty but for replies), and whether the template rewrote
    history at this turn.  The formatted conversation is its pieces joined by ``position``; rows
    come sorted by conversation and position within their task.

    Null roles and texts are empty.  Turns are in the order of ``turn`` (null first), equal ones
    in that of role and text; repeated rows are repeated turns.  Rows with a null conversation
    form one conversation.  No rows give no rows.  Other columns are ignored.

    Every prefix holds all turns from the first, so work is quadratic in the turns of a
    conversation.  ``segment`` renders within so many turns instead, and is only right for
    templates that look back one turn at most; those declared local take ``SEGMENT``.
    """
    if segment is None and getattr(template, "local", False):
        segment = SEGMENT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, position, at, before = object(), 0, 0, []
        rows: list[tuple] = []
        for conv, turns in _segments(batches, segment):
            if conv != now:
                now, position, at, before = conv, 0, 0, []
            for piece, start, end, rewritten in render_segment(turns, template, before):
                rows.append((conv, position, at, at + len(piece), start, end, rewritten, piece))
                position, at = position + 1, at + len(piece)
                if len(rows) >= 2048:
                    yield _pieces(rows)
                    rows = []
            before = turns[-1:]
        if rows:
            yield _pieces(rows)

    small_batches(conversations.sparkSession)
    rows = conversations.select(
        column(conv_col).cast("bigint").alias("conv_id"),
        F.coalesce(column(role_col), F.lit("")).alias("role"),
        F.coalesce(column(text_col), F.lit("")).alias("text"),
        column(turn_col).alias("turn"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, TURN_SCHEMA)


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 6 + [pa.bool_(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)],
        names=[
            "conv_id", "position", "start", "end", "loss_start", "loss_end", "rewritten",
            "piece",
        ],
    )


def _parse(pieces: str) -> Iterator[Turn]:
    at = 0
    while at < len(pieces):
        m = _TURN.match(pieces, at)
        if m is None:
            raise ValueError("the formatted text is not a sequence of marked turns")
        yield unescape(m[1]), unescape(m[2])
        at = m.end()


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of conversations, read from the pieces that ``marked_turns`` made.

    Takes the rows of ``format_turns`` in their order (no shuffle in between).  Turns and loss
    text are parsed from the formatted text and unescaped; digests are running, so a long
    conversation is never held whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(
            batch.column("conv_id").to_pylist(), batch.column("loss_start").to_pylist(),
            batch.column("loss_end").to_pylist(), batch.column("piece").to_pylist(), strict=True,
        ))
        done: list[tuple] = []
        for conv, pieces in groupby(rows, key=lambda row: row[0]):
            turns_hash, loss_hash = hashlib.sha256(), hashlib.sha256()
            n = loss_chars = chars = 0
            for _, start, end, piece in pieces:
                for role, text in _parse(piece):
                    turns_hash.update(f"{role}\n{text}\n".encode())
                    n += 1
                loss = unescape(piece[start:end])
                loss_hash.update(loss.encode())
                loss_chars += len(loss)
                chars += len(piece)
            done.append(
                (conv, n, turns_hash.hexdigest(), loss_chars, loss_hash.hexdigest(), chars)
            )
            if len(done) == 2048:
                yield _summaries(done)
                done = []
        if done:
            yield _summaries(done)

    return formatted.select("conv_id", "loss_start", "loss_end", "piece").mapInArrow(
        run, SUMMARY_SCHEMA
    )


def _summaries(rows: list[tuple]) -> pa.RecordBatch:
    ints, text = pa.int64(), pa.string()
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), (ints, ints, text, ints, text, ints))],
        names=[
            "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
        ],
    )
