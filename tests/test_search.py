"""How texts are searched: the pattern that a search uses, and the expressions around it."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from maskwright import RedactOptions, redact
from maskwright.functions import spans as sp
from maskwright.functions.catalog import BUILT_INS, listed
from maskwright.functions.generators import scramble
from maskwright.operators.redact import detect

PARTS = (
    "0", "12", "123", "1234", "4111 1111 1111 1111", "a", "Ab", "cafe", "é", "É", "ß", "́", "²", "_", "-", ".",
    ",", ":", "::", "/", "@", "+", "(", ")", " ", "\n", "http://", "www.", "h", "w", "t", "Jan", "Dec. ", "st ", " Old Mill Road",
    " rue ", "Hauptstraße 5", "1.2.3.4", "2021-02-03", "(212) 555-1234", "+44 20 ", "fe80", "00:11:22:33:44:55",
    "DE89 3704 0044 0532 0130 00", "123-45-6789", "0123456789abcdef" * 2, "\U0001f600", "user.name", "x@y.co", "ü@ö.de",
)


def texts(n=400):
    draw = random.Random(3)
    return ["".join(draw.choices(PARTS, k=draw.randint(1, 14))) for _ in range(n)]


def test_a_search_that_passes_runs_finds_what_the_pattern_finds(spark):
    df = spark.createDataFrame([(t,) for t in texts()], "text string")
    for pattern in sp.built_in_patterns(BUILT_INS):
        own = F.coalesce(pattern.pieces(F.col("text")), F.array("text"))
        found = df.select(
            pattern.matches(F.col("text")).alias("want"),
            F.filter(own, lambda p, i: i % 2 == 1).alias("got"), F.array_join(own, "").alias("whole"), "text",
        ).collect()
        assert [r.want for r in found] == [r.got for r in found], pattern.label
        assert all(r.whole == r.text for r in found)


def test_no_gate_is_a_second_search(spark):
    df = spark.createDataFrame([("x",)], "text string")
    for pattern in sp.built_in_patterns(BUILT_INS):
        plan = df.select(pattern.pieces(F.col("text")))._jdf.queryExecution().analyzed().toString()
        assert "RLIKE" not in plan, pattern.label


def test_listed_classes_hold_the_same_characters():
    for pattern in (r"[0-9A-F]", r"\d+[.-]\w", r"[+(0-9]", r"[ .()-]"):
        for code in range(256):
            for text in (chr(code), f"1-{chr(code)}", f"1{chr(code)}a"):
                assert bool(re.fullmatch(pattern, text, re.A)) == bool(re.fullmatch(listed(pattern), text, re.A))


def test_patterns_are_searched_outside_of_lambdas(spark):
    # Lambdas are interpreted: a search inside of one costs a multiple.
    df = spark.createDataFrame([("x",)], "text string")
    plan = detect(df, "text")._jdf.queryExecution().optimizedPlan().toString()
    searches = [line for line in plan.splitlines() if "regexp_replace(text" in line or "__c0" in line and "regexp_replace" in line]
    assert searches and not any("lambdafunction(regexp_replace(__c0" in line for line in searches)
    assert any("AS __m0" in line for line in searches)


def test_one_and_many_matches_of_a_type(spark):
    one = "card 4111111111111111 mail a@x.org"
    many = " ".join(f"u{i}@x.org 4111111111111111 4000000000000 de89370400440532013000 1.2.3.{i}" for i in range(70))
    done = {r.text: r for r in redact(
        spark.createDataFrame([(one,), (many,), ("\x01" + one,), (None,)], "text string"), "text",
        RedactOptions()).collect()}
    assert done[one].redacted_text == "card [CREDIT_CARD] mail [EMAIL_ADDRESS]"
    assert done["\x01" + one].redacted_text == "\x01card [CREDIT_CARD] mail [EMAIL_ADDRESS]"
    # Thirteen digits without a checksum are no card number; the IBAN in small letters has one.
    assert done[many].redacted_text == " ".join(
        ["[EMAIL_ADDRESS] [CREDIT_CARD] 4000000000000 [IBAN_CODE] [IP_ADDRESS]"] * 70)
    assert done[many].entities[-1].end == len(many) and done[None].entities_found == 0


def by_hand(value):
    out = ""
    for i, ch in enumerate(value):
        byte = hashlib.sha256(f"k|L|{value}#{i // 32}".encode()).digest()[i % 32]
        out += (str(byte % 10) if "0" <= ch <= "9" else chr(97 + byte % 26) if "a" <= ch <= "z"
                else chr(65 + byte % 26) if "A" <= ch <= "Z" else ch)
    return out


def test_scrambling_long_and_odd_values(spark):
    values = ["", "a", "0", "é", "aZ9-é\U0001f600x", "x" * 31, "x" * 32, "Y7" * 16 + "1", "ab" * 500]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    expression = scramble("k", F.lit("L"), F.col("v"))
    assert "conv(" not in df.select(expression)._jdf.queryExecution().analyzed().toString()
    made = [r.m for r in df.select(expression.alias("m")).collect()]
    assert made[5:9] == [by_hand(v) for v in values[5:9]]
    for value, got in zip(values, made):
        assert re.sub("[0-9]", "9", re.sub("[a-z]", "x", re.sub("[A-Z]", "X", got))) == re.sub(
            "[0-9]", "9", re.sub("[a-z]", "x", re.sub("[A-Z]", "X", value)))
