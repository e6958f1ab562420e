"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are the powers of two that sum to n
(n = 2048 q + the binary digits of the rest).  Every piece is one sequence: no sequence crosses
documents, and as each length is a power of two nothing is padded.  Sequences of equal length
form a bucket; a training step draws from one bucket, so its batch is rectangular.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from maskwright.llm.common import Memo, chunks, column, per_process, small_batches

LIMIT = 2048
EOS = 1
TOKENIZER = "word_bpe_49k.json"
# Words remembered per Python worker and generation.
MEMO_WORDS = 300000
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, bucket int"
)

# Texts of these characters alone are unchanged by NFC and lower-cased character by character.
# (İ, Ⱥ and Ⱦ lie between the ranges: their lower-case forms lie outside.)
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-įı-ȹȻ-Ƚȿ-ʯ‐-‧‰-›€]*")
_LATIN = "a-zªµºß-öø-ʯ"
# Words of the tokenizer's pre-tokenizer, for plain texts in lower case.
_WORDS = re.compile(
    f"[{_LATIN}]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9²³¹¼-¾]|[^\\s{_LATIN}0-9²³¹¼-¾]+"
)


class WordEncoder:
    """Ids of whole texts, equal to the tokenizer's, with words remembered.

    The tokenizer cuts a text into words and encodes each by itself, so the ids of a plain text
    are the joined ids of its words.  Other texts (combining characters, special tokens) are
    encoded whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo = Memo(MEMO_WORDS)

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words as little-endian unsigned 32-bit integers."""
        out = []
        for i in range(0, len(words), 4096):
            part = words[i:i + 4096]
            done = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            owner = np.array(done.word_ids, dtype=np.int64)
            ids = np.array(done.ids, dtype="<u4")
            cuts = np.searchsorted(owner, np.arange(len(part) + 1))
            raw = ids.tobytes()
            out += [raw[4 * a:4 * b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        words, whole = [], {}
        for i, text in enumerate(texts):
            if not text:
                words.append(())
            elif _PLAIN.fullmatch(text) and "<|" not in text:
                words.append(_WORDS.findall(text.lower()))
            else:
                words.append(())
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                whole[i] = np.array(ids, dtype="<u4").tobytes()
        out = self.memo.joined(words, self._words)
        for i, ids in whole.items():
            out[i] = ids
        return out


def piece_lengths(total: int, limit: int = LIMIT) -> list[int]:
    """Full pieces, then the binary digits of the rest, longest first."""
    rest = total % limit
    return [limit] * (total // limit) + [
        1 << k for k in range(limit.bit_length() - 1, -1, -1) if rest >> k & 1
    ]


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
    eos: int = EOS,
    limit: int = LIMIT,
) -> DataFrame:
    """Sequences of at most ``limit`` tokens: one row per piece, with its token ids.

    ``ids`` holds little-endian unsigned 32-bit ids, ``start`` the ids of the document before
    the piece, ``bucket`` the binary logarithm of the length.  A piece is a sequence, so
    ``offset`` is 0.  ``sequence_id`` is unique; the ids of a task lie together.  The work is
    one pass over the texts, without a shuffle.

    A null or empty text is a document of the end token alone.  Rows are packed one by one:
    repeated rows, ids or null ids give as many documents.  No rows give no rows.  Other columns
    of ``docs`` are ignored, whatever their names.
    """
    if limit < 1 or limit & (limit - 1):
        raise ValueError("limit must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        from pyspark import TaskContext

        encoder = per_process(
            ("packing", tokenizer), lambda: WordEncoder(public_tokenizers.path(tokenizer))
        )
        end = np.array([eos], dtype="<u4").tobytes()
        number = TaskContext.get().partitionId() << 36
        for batch, texts in chunks(batches, "text"):
            owners, starts, lengths, ids, totals = [], [], [], [], []
            for row, raw in enumerate(encoder.encode(texts)):
                raw += end
                total, at = len(raw) // 4, 0
                for length in piece_lengths(total, limit):
                    owners.append(row)
                    starts.append(at)
                    lengths.append(length)
                    ids.append(raw[4 * at:4 * (at + length)])
                    totals.append(total)
                    at += length
            n = len(owners)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owners, pa.int64())),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array(totals, pa.int64()),
                    pa.array(np.arange(number, number + n)),
                    pa.array(np.zeros(n, dtype=np.int64)),
                    pa.array([x.bit_length() - 1 for x in lengths], pa.int32()),
                ],
                names=[
                    "doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset",
                    "bucket",
                ],
            )
            number += n

    small_batches(docs.sparkSession)
    rows = docs.select(
        column(id_col).cast("bigint").alias("doc_id"), column(text_col).alias("text")
    )
    return rows.mapInArrow(run, SCHEMA)


def write_buckets(packed: DataFrame, path: str) -> None:
    """One folder per length, so that a trainer reads only sequences of one length."""
    packed.write.partitionBy("bucket").parquet(path)
