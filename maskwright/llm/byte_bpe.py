"""Byte-level BPE encoding and decoding with an automaton and backtracking.

Bytes are mapped to Latin-1 characters, so that pyahocorasick works on them.  A piece is encoded
from the left with the longest token that matches; adjacent tokens must be compatible, that is
the merges must leave exactly the two of them.  Where they are not, the next shorter token is
tried, and where none is left the position is closed and the token before it is shortened.  A
position is closed once, so the work is linear in the piece.  The result equals that of applying
the merges in order.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from maskwright.llm.common import Memo, chunks, column, per_process, small_batches

RANKS = "byte_bpe_50k.tiktoken"
# Pieces and token pairs remembered per Python worker (and generation, for pieces).
MEMO_PIECES = 300_000
MEMO_PAIRS = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class ByteEncoder:
    def __init__(self, ranks: dict[bytes, int]) -> None:
        import ahocorasick

        self.ranks = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token in self.ranks:
            self.automaton.add_word(token, len(token))
        self.automaton.make_automaton()
        self.spines: dict[tuple[str, bool], list[tuple[str, float]]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.memo = Memo(MEMO_PIECES)

    def _halves(self, token: str) -> tuple[str, str]:
        """The two parts whose merge makes a token of two or more bytes."""
        parts = list(token)
        while len(parts) > 2:
            ranks = [self.ranks.get(a + b, -1) for a, b in zip(parts, parts[1:])]
            best = min((r for r in ranks if r >= 0), default=-1)
            if best < 0:
                break
            i = ranks.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        if len(parts) != 2:
            raise ValueError(f"no merges make the token {token!r}")
        return parts[0], parts[1]

    def _spine(self, token: str, right: bool) -> list[tuple[str, float]]:
        """The parts at one edge of a token, largest first, each with the rank at which the
        merges of this token use it up (never, for the token itself)."""
        key = (token, right)
        if key not in self.spines:
            spine, used = [], float("inf")
            while True:
                spine.append((token, used))
                if len(token) == 1:
                    break
                used = self.ranks[token]
                token = self._halves(token)[right]
            self.spines[key] = spine
        return self.spines[key]

    def compatible(self, left: str, right: str) -> bool:
        """Whether the merges of both tokens' bytes end in exactly these two tokens.

        A merge across the border happens if some part at the right edge of ``left`` and some
        part at the left edge of ``right`` form a token before either is used up otherwise.  Of
        equal ranks the leftmost merge comes first.
        """
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            known = True
            for a, a_used in self._spine(left, True):
                a_made = self.ranks[a] if len(a) > 1 else -1
                for b, b_used in self._spine(right, False):
                    b_made = self.ranks[b] if len(b) > 1 else -1
                    if a_made >= b_used or b_made > a_used:
                        continue  # they are never there at the same time
                    rank = self.ranks.get(a + b)
                    if rank is not None and rank < a_used and rank <= b_used:
                        known = False
                        break
                if not known:
                    break
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def piece(self, piece: str) -> list[int]:
        """Ids of one piece, given as Latin-1 characters."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size = len(piece)
        longest = [1] * size
        for end, length in self.automaton.iter(piece):
            begin = end - length + 1
            if length > longest[begin]:
                longest[begin] = length
        is_open = [True] * (size + 1)
        chosen: list[str] = []
        at, length = 0, longest[0]
        while at < size:
            before = chosen[-1] if chosen else None
            found = False
            while length:
                token = piece[at:at + length]
                if (
                    is_open[at + length]
                    and token in self.ranks
                    and (before is None or self.compatible(before, token))
                ):
                    found = True
                    break
                length -= 1
            if found:
                chosen.append(token)
                at += length
                length = longest[at] if at < size else 0
            else:
                is_open[at] = False
                if before is None:
                    raise ValueError(f"the ranks cannot encode {piece!r}")
                chosen.pop()
                at -= len(before)
                length = len(before) - 1
        return [self.ranks[token] for token in chosen]

    def _pieces(self, pieces: list[str]) -> Iterator[bytes]:
        for piece in pieces:
            ids = self.piece(piece.encode().decode("latin-1"))
            yield np.array(ids, dtype="<u4").tobytes()

    def encode(self, texts: list[list[str]]) -> list[bytes]:
        """Ids of texts given as lists of pieces: little-endian unsigned 32-bit integers."""
        known = self.memo.fill(texts, self._pieces)
        return [b"".join(map(known.__getitem__, pieces)) for pieces in texts]


def _encoder(ranks: str) -> ByteEncoder:
    import public_tokenizers

    return per_process(
        ("byte_bpe", ranks), lambda: ByteEncoder(read_ranks(public_tokenizers.path(ranks)))
    )


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks: str = RANKS,
    pattern: str | None = None,
) -> DataFrame:
    """(doc_id, ids): token ids of every whole text as little-endian unsigned 32-bit integers.

    ``pattern`` cuts a text into pieces that are encoded separately (by default the pattern that
    comes with the ranks); strings of special tokens are ordinary text.  One pass, no shuffle.

    A null or empty text has no ids (an empty binary).  Rows are encoded one by one: repeated
    rows, ids and null ids stay as they are.  No rows give no rows.  Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        import regex

        encoder = _encoder(ranks)
        cut = regex.compile(pattern or public_tokenizers.PATTERN).findall
        for batch, texts in chunks(batches, "text"):
            ids = encoder.encode([cut(text) if text else () for text in texts])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"]
            )

    small_batches(docs.sparkSession)
    rows = docs.select(
        column(id_col).cast("bigint").alias("doc_id"), column(text_col).alias("text")
    )
    return rows.mapInArrow(run, "doc_id bigint, ids binary")


def decode(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """(doc_id, ids, decoded): the bytes of encoded texts; null ids give null bytes.

    Ids that the ranks do not hold are an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks)
        tokens = per_process(
            ("byte_bpe", ranks, "tokens"),
            lambda: {rank: token.encode("latin-1") for rank, token in encoder.tokens.items()},
        )
        for batch in batches:
            out = []
            for raw in batch.column(1).to_pylist():
                if raw is None:
                    out.append(None)
                    continue
                ids = np.frombuffer(raw, dtype="<u4").tolist()
                out.append(b"".join(map(tokens.__getitem__, ids)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.binary())],
                names=["doc_id", "ids", "decoded"],
            )

    small_batches(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id bigint, ids binary, decoded binary"
    )
