"""Detection, resolution, policies and surrogates on hand-made texts and random spans."""

import random
import re

import pytest
from pyspark.sql import functions as F

from maskwright import GeneratorMetadata, LabelList, RedactOptions, detect, redact, spans_of
from maskwright.functions import generators as gen
from maskwright.functions import spans as sp
from maskwright.functions.catalog import ANY_BUILT_IN_GATE, BUILT_INS
from maskwright.operators.detectors import dictionary_detector, register_detector
from maskwright.operators.policy import RedactOptions as Options
from maskwright.operators.redact import flat_candidates

TEXTS = [
    "", "no hit", "a@b.com", "a@b.com 1.2.3.4", "x a@b.com", "a@b.com,c@d.org",
    "😀 1.2.3.4 é (212) 555-0100", "card https://h.example/4111111111111111/x end",
    "John Smith's SSN is 456-78-9012", "$1 \\ a@b.com \\$0", None,
    "2024-01-31 aa:bb:cc:dd:ee:ff DE89370400440532013000",
    "123e4567-e89b-12d3-a456-426614174000",
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")


def check_invariants(rows):
    for row in rows:
        if row.text is None:
            assert row.redacted_text is None and row.entities_found == 0
            continue
        assert row.entities_found == len(row.entities)
        at, new_at, rebuilt = 0, 0, ""
        for e in row.entities:
            assert at <= e.start < e.end <= len(row.text)
            assert row.text[e.start : e.end] == e.text
            new = e.text if e.new_text is None else e.new_text
            rebuilt += row.text[at : e.start] + new
            assert e.new_start == new_at + e.start - at
            assert row.redacted_text[e.new_start : e.new_end] == new
            at, new_at = e.end, e.new_end
        assert rebuilt + row.text[at:] == row.redacted_text


@pytest.mark.parametrize("handling", ["Redaction", "Synthesis", "GroupingSynthesis", "Off"])
def test_invariants(docs, handling):
    rows = redact(docs, "text", RedactOptions(generator_default=handling, key="test key")).collect()
    check_invariants(rows)
    if handling == "Off":
        assert all(r.text == r.redacted_text for r in rows)


def test_invariants_on_corpus(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = redact(docs, "text", RedactOptions(generator_default="Synthesis", key="test key")).collect()
    check_invariants(rows)
    assert sum(r.entities_found for r in rows) == 24


def test_gate_is_implied_by_every_pattern(spark):
    samples = {
        "EMAIL_ADDRESS": "a@b.com", "PHONE_NUMBER": "(212) 555-0100", "URL": "http://x",
        "IP_ADDRESS": "1.2.3.4", "MAC_ADDRESS": "aa:bb:cc:dd:ee:ff",
        "CREDIT_CARD": "4111 1111 1111 1111", "IBAN_CODE": "DE89370400440532013000",
        "US_SSN": "078-05-1120", "UUID": "abcdefab-abcd-abcd-abcd-abcdefabcdef",
        "SECRET_TOKEN": "a" * 40, "DATE_TIME": "2024-01-31",
        "STREET_ADDRESS": "1 Main Street",
    }
    for d in BUILT_INS:
        text = samples[d.label]
        found = spark.range(1).select(F.rlike(F.lit(text), F.lit(d.pattern))).first()[0]
        assert found
        assert d.gate in text if d.gate_is_literal else re.search(d.gate, text)
        assert re.search(ANY_BUILT_IN_GATE, text)


def brute_force(cands):
    kept = []
    for c in sorted(cands, key=lambda c: (c[2], c[0] - c[1], c[0], c[3])):
        if all(k[1] <= c[0] or c[1] <= k[0] for k in kept):
            kept.append(c)
    return sorted(kept)


def test_resolution_against_brute_force(spark):
    rng, rows = random.Random(5), []
    for i in range(40):
        n = rng.choice([0, 1, 2, 5, 30, 150, 400])
        seen = {
            (s, s + rng.randint(1, 9), rng.randint(0, 2), rng.choice("ABC"))
            for s in (rng.randint(0, n * 6 + 1) for _ in range(n))
        }
        rows.append((i, [(*c, "t", 0.9, None) for c in seen]))
    df = spark.createDataFrame(rows, f"id int, c array<{sp.CANDIDATE_TYPE}>")
    for row, (_, cands) in zip(df.select("id", sp.resolve(F.col("c")).alias("r")).orderBy("id").collect(), rows):
        assert [tuple(x)[:4] for x in row.r] == brute_force([c[:4] for c in cands])


def test_many_spans_in_one_text(spark):
    text = " | ".join(f"user{i}@mail.example.com at http://10.0.0.{i % 256}/x{i}" for i in range(700))
    rows = redact(spark.createDataFrame([(text,)], "text string"), "text").collect()
    check_invariants(rows)
    assert rows[0].entities_found == 1400


def test_running_sum(spark):
    for n in (0, 1, 63, 64, 65, 1000):
        values = list(range(n))
        got = spark.createDataFrame([(values,)], "v array<int>").select(
            sp.running_sum(F.col("v")).alias("r")
        ).first().r
        assert got == [sum(values[: i + 1]) for i in range(n)]


def test_filter_on_result_keeps_plan_small(docs):
    df = redact(docs, "text").filter("entities_found > 0")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == len(BUILT_INS)
    assert df.count() == 10


def test_redaction_has_no_shuffle(docs):
    plan = redact(docs, "text")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_determinism_across_partitions(docs):
    options = RedactOptions(generator_default="Synthesis", key="test key")
    one = sorted(redact(docs.coalesce(1), "text", options).select("id", "redacted_text").collect())
    many = sorted(redact(docs.repartition(7), "text", options).select("id", "redacted_text").collect())
    assert one == many


def test_allow_beats_block_and_built_in(spark):
    df = spark.createDataFrame([("mail a@b.com from 10.0.0.1 or 10.0.0.2",)], "text string")
    options = RedactOptions(
        label_allow_lists={"IP_ADDRESS": LabelList(["10.0.0.1"]), "ORGANIZATION": LabelList(["b.com"])},
        label_block_lists={"IP_ADDRESS": LabelList(regexes=["^10"])},
    )
    got = flat_candidates(detect(df, "text", options), []).select("label", "text", "score").collect()
    assert [tuple(g) for g in got] == [("ORGANIZATION", "b.com", 1.0), ("IP_ADDRESS", "10.0.0.1", 1.0)]


def test_swaps_only_under_synthesis(spark):
    df = spark.createDataFrame([(1, "a@b.com 1.2.3.4")], "id int, text string")
    meta = {
        "EMAIL_ADDRESS": GeneratorMetadata(swaps={"a@b.com": "swap@x.org"}),
        "IP_ADDRESS": GeneratorMetadata(swaps={"1.2.3.4": "9.9.9.9"}),
    }
    options = RedactOptions(
        generator_config={"EMAIL_ADDRESS": "Synthesis"}, generator_metadata=meta, key="test key"
    )
    assert redact(df, "text", options).first().redacted_text == "swap@x.org [IP_ADDRESS]"
    table = spark.createDataFrame(
        [("EMAIL_ADDRESS", "a@b.com", "table@x.org")], "label string, original string, replacement string"
    )
    swapped = redact(df, "text", RedactOptions(generator_default="Synthesis", key="test key"), swaps=table)
    assert swapped.first().redacted_text.startswith("table@x.org 10.")


def test_salted_lookup_equals_broadcast(spark, monkeypatch):
    from maskwright.operators import sizing

    left = spark.range(2000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 50) END AS k")
    table = spark.createDataFrame([("hot", 1), ("k7", 2)], "k string, v int")
    plain = {how: sorted(sizing.lookup_join(left, table, ["k"], how, ["id"]).select("id").collect())
             for how in ("left", "inner", "left_anti", "left_semi")}
    monkeypatch.setattr(sizing, "is_bounded", lambda t: False)
    for how, want in plain.items():
        assert sorted(sizing.lookup_join(left, table, ["k"], how, ["id"]).select("id").collect()) == want


def test_dictionary_detector(spark):
    register_detector("names", dictionary_detector("NAME_GIVEN", ["Zoë", "John"]))
    df = spark.createDataFrame([("Zoë met John, not Johnny",)], "text string")
    got = redact(df, "text", RedactOptions(custom_entities=["names"])).first()
    assert got.redacted_text == "[NAME_GIVEN] met [NAME_GIVEN], not Johnny"


def test_surrogates(spark):
    label = F.lit("X")
    row = spark.createDataFrame([("Ab-09 😀é",)], "v string").select(
        gen.scramble("k", label, F.col("v")).alias("s"),
        gen.generate("CreditCard", "k", label, F.col("v")).alias("card"),
        F.call_function("luhn_check", gen.generate("CreditCard", "k", label, F.col("v"))).alias("ok"),
        gen.generate("Ssn", "k", label, F.col("v")).alias("ssn"),
        gen.generate("PhoneNumber", "k", label, F.col("v")).alias("phone"),
    ).first()
    assert re.fullmatch(r"[A-Z][a-z]-\d\d 😀é", row.s)
    assert row.ok and re.fullmatch(r"4\d{15}", row.card)
    assert re.fullmatch(r"9\d\d-\d\d-\d{4}", row.ssn)
    assert re.fullmatch(r"\(\d{3}\) 555-01\d\d", row.phone)


@pytest.mark.parametrize(
    "bad",
    [
        {"generator_default": "Mask"}, {"generator_config": {"URL": "x"}},
        {"generator_metadata": {"URL": GeneratorMetadata(version="V3")}},
        {"generator_metadata": {"URL": GeneratorMetadata(custom_generator="Nope")}},
        {"labels": ["NOPE"]}, {"label_allow_lists": {"A": LabelList([""])}},
        {"label_block_lists": {"A": LabelList(regexes=["x*"])}},
    ],
)
def test_bad_options_raise(bad):
    with pytest.raises(ValueError):
        Options(**bad)


def test_entity_table(docs):
    rows = spans_of(redact(docs, "text"), ["id"]).filter("id = 3").orderBy("ord").collect()
    assert [(r.ord, r.label, r.start, r.new_start) for r in rows] == [
        (0, "EMAIL_ADDRESS", 0, 0), (1, "IP_ADDRESS", 8, 16)
    ]


def test_texts_are_searched_once(spark):
    """One search of a text finds the matches and the pieces between them, also where the text
    holds the mark that parts them."""
    texts = ["a1b22c", "1", "", "\x01" + "1\x01x2", "x" + "7 " * 200, "\x01", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    word = sp.Pattern("[0-9]+", "N", 1, once=True)
    plan = df.select(word.pieces(F.col("text")))._jdf.queryExecution().analyzed().toString()
    assert "ELSE split(regexp_replace(" in plan
    rows = df.select("text", sp.pattern_candidates(F.col("text"), [word]).alias("c")).collect()
    for text, found in rows:
        want = [(m.start(), m.end(), m[0]) for m in re.finditer("[0-9]+", text or "")]
        assert [(c.start, c.end, c.text) for c in found] == want


def test_check_digits_of_ibans(spark):
    rng = random.Random(5)
    values = ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "fr14 2004 1010 0505 0001 3M02 606"]
    for n in (4, 6, 18, 34, 35, 60):
        values += ["".join(rng.choices("ABXYZ", k=2)) + "".join(rng.choices("0123456789", k=n))
                   for _ in range(200)]

    def valid(value):
        bare = value.replace(" ", "").upper()
        return int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1

    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select("v", sp.mod97_valid(F.col("v")).alias("ok")).collect()
    assert [r.ok for r in got] == [valid(r.v) for r in got] and any(r.ok for r in got[3:])


def test_long_texts_are_cut_into_words_once(spark):
    from pyspark.sql import types as T

    from maskwright.operators.redact import dictionary_spans

    texts = [("a", "é two_two  two"), (None, "two"), ("a", "é two_two  two"), ("b", None), ("c", "İ𝒳two two"), ("d", "")]
    df = spark.createDataFrame(texts, "key string, text string")
    words = spark.createDataFrame([("two",), ("two",), (None,)], "word string")
    found = dictionary_spans(df, "key", "text", words, "ORGANIZATION")
    # Words leave by Arrow batches, no row holds an array of them.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "arrays_zip" not in plan
    assert found.schema["key"].dataType == T.StringType()
    got = sorted((r.key or "", r.text, r.start, r.end) for r in found.collect())
    twice = [("a", "two", s, s + 3) for s in (2, 2, 6, 6, 11, 11)]
    assert got == [("", "two", 0, 3), *twice, ("c", "two", 6, 9)]
