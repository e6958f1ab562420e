"""Packing and byte-level BPE against the tokenizer libraries."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from maskwright.llm import byte_bpe, packing

TEXTS = [
    (1, "It's a test, and we'll see: 'tis 12 o'clock."), (2, None), (3, ""), (3, ""), (None, "x"),
    (4, "word " * 5000), (5, "Ünïcödé é 日本語 🙂 <|endoftext|> ſ's a\x85b\xa0c"), (6, " \n\t "),
    (7, "a" * 3000), (8, "x²½ don'T “quoted” – € İ"), (4, "word " * 5000),
]


def _odd_texts(n=300):
    pick = random.Random(3)
    letters = "abe stre in\n\t'é日1290=-.AZ "
    return ["".join(pick.choice(letters) for _ in range(pick.randint(0, 200))) for _ in range(n)]


def test_pieces_hold_each_id_once(spark, frame):
    texts = TEXTS + [(100 + i, t) for i, t in enumerate(_odd_texts())]
    rows = packing.pack(frame(texts)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = sorted(
        (str(i), (tokenizer.encode(t, add_special_tokens=False).ids if t else []) + [1])
        for i, t in texts
    )
    by_doc, docs = [], {}
    for r in sorted(rows, key=lambda r: r["sequence_id"]):
        assert r["length"] & (r["length"] - 1) == 0 and r["length"] <= 2048 and r["offset"] == 0
        assert len(r["ids"]) == 4 * r["length"] and 1 << r["bucket"] == r["length"]
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        if r["start"] == 0:
            docs = {"ids": []}
            by_doc.append((str(r["doc_id"]), docs["ids"]))
        assert r["start"] == len(docs["ids"])
        docs["ids"] += ids
    assert sorted(by_doc) == want
    assert len({r["sequence_id"] for r in rows}) == len(rows)


def test_lengths_are_binary_digits():
    for n in (1, 2, 2047, 2048, 2049, 10_000):
        lengths = packing.piece_lengths(n)
        assert sum(lengths) == n and lengths == sorted(lengths, reverse=True)
        assert len([x for x in lengths if x < 2048]) == bin(n % 2048).count("1")


def test_limit_must_be_a_power_of_two(frame):
    with pytest.raises(ValueError):
        packing.pack(frame([(1, "x")]), limit=1000)


def test_no_documents_no_pieces(frame):
    assert packing.pack(frame([])).collect() == []
    assert byte_bpe.decode(byte_bpe.encode(frame([]))).collect() == []


def test_buckets_are_folders(spark, frame, tmp_path):
    packing.write_buckets(packing.pack(frame(TEXTS)), str(tmp_path / "packed"))
    back = spark.read.parquet(str(tmp_path / "packed" / "bucket=11"))
    assert {r["length"] for r in back.select("length").collect()} == {2048}


def test_byte_bpe_equals_the_library(frame):
    texts = TEXTS + [(100 + i, t) for i, t in enumerate(_odd_texts())]
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS))
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    rows = byte_bpe.decode(byte_bpe.encode(frame(texts))).collect()
    got = sorted(
        (str(r["doc_id"]), np.frombuffer(bytes(r["ids"]), "<u4").tolist(), bytes(r["decoded"]))
        for r in rows
    )
    want = sorted((str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t in texts)
    assert got == want


def test_compatibility_is_what_merges_leave():
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS))
    encoder = byte_bpe.ByteEncoder(ranks)
    library = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    pick = random.Random(5)
    tokens = [t for t in ranks if t.isascii() and t.decode().isprintable()]
    for _ in range(3000):
        a, b = pick.choice(tokens), pick.choice(tokens)
        left = library.encode_ordinary((a + b).decode()) == [ranks[a], ranks[b]]
        assert encoder.compatible(a.decode(), b.decode()) == left, (a, b)


def test_null_ids_decode_to_null(spark):
    rows = spark.createDataFrame([(1, None)], "doc_id bigint, ids binary")
    assert byte_bpe.decode(rows).first()["decoded"] is None


def test_ids_of_every_character_of_the_plain_range():
    """Each character within a word, at its ends and alone, as the tokenizer has it."""
    path = public_tokenizers.path(packing.TOKENIZER)
    encoder, tokenizer = packing.WordEncoder(path), Tokenizer.from_file(path)
    texts = [t for c in map(chr, range(9, 0x250)) for t in (f"{c}bc", f"ab{c}cd é", f"x {c} y{c}")]
    texts += [t for c in map(chr, range(0x2000, 0x20B0)) for t in (f"{c}bc", f"ab{c}cd")]
    rng = random.Random(9)
    texts += ["".join(chr(rng.randint(9, 0x250)) for _ in range(rng.randint(1, 30)))
              for _ in range(3000)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, ascii(text)


def test_long_pieces_are_not_remembered():
    """10,000 distinct pieces of 100 KB leave nothing behind."""
    from maskwright.llm.common import Memo

    memo = Memo(1000)
    for i in range(0, 10_000, 10):
        keys = [f"{k}{'x' * 100_000}" for k in range(i, i + 10)] + [f"s{i}"]
        got = memo.fill([keys, keys[:3]], lambda new: [len(key) for key in new])
        assert [got[key] for key in keys] == [len(key) for key in keys]
        assert sum(map(len, memo.young)) + sum(map(len, memo.old)) < 1_200_000
    assert memo.fill([["s0"]], lambda new: [0])["s0"] in (0, 2)
    assert max(map(len, memo.young)) <= 64
