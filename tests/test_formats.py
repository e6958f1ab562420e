"""Entity types against the standards of their formats, and texts that are hard to match."""

import pytest
from pyspark.sql import functions as F

from maskwright import RedactOptions, redact
from maskwright.functions import spans as sp
from maskwright.functions.catalog import ANY_BUILT_IN_GATE, BUILT_INS, DETECTORS
from maskwright.operators.redact import detect, flat_candidates

# Values of each format, and look-alikes that are none.  From RFC 5321/6531, E.164, RFC 4291,
# ISO/IEC 7812, ISO 13616, RFC 4122, ISO 8601 and postal usage.
VALUES = {
    "EMAIL_ADDRESS": [
        "bob@example.com", "j.doe+tag@mail.example.co.uk", "jürgen@example.com", "bob@münchen.de",
        "用户@例子.公司", "a_b%c-d@x-y.org", "ÄÖ@straße.example",
    ],
    "PHONE_NUMBER": [
        "(212) 555-0100", "+1 (212) 555-0100", "212-555-0100", "212.555.0100", "+44 20 7946 0958",
        "+442079460958", "+44 (0)20 7946 0958", "+49 30 901820", "+12 345 678 901 234 567 890",
        "020 7946 0958", "01 23 45 67 89", "0151-555-0100",
    ],
    "URL": ["https://example.com/a?b=c", "http://1.2.3.4:80/", "www.acme.org/x?u=bob"],
    "IP_ADDRESS": [
        "192.0.2.1", "2001:db8:0:0:0:0:2:1", "2001:db8::2:1", "::1", "2001:db8::",
        "::ffff:192.0.2.1", "64:ff9b::192.0.2.33", "fe80::1ff:fe23:4567:890a",
        "0:0:0:0:0:ffff:192.0.2.1", "1:2:3:4:5:6:7::",
    ],
    "MAC_ADDRESS": ["00:1B:44:11:3a:b7"],
    "CREDIT_CARD": [
        "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111", "3782 822463 10005",
        "378282246310005", "4222222222222", "6304000000000000000",
    ],
    "IBAN_CODE": [
        "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "de89 3704 0044 0532 0130 00",
        "gb29nwbk60161331926819", "GB29 NWBK 6016 1331 9268 19",
        "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "no93 8601 1117 947",
    ],
    "US_SSN": ["078-05-1120"],
    "UUID": ["123e4567-e89b-12d3-a456-426614174000", "ABCDEFAB-ABCD-ABCD-ABCD-ABCDEFABCDEF"],
    "SECRET_TOKEN": ["d41d8cd98f00b204e9800998ecf8427e", "a" * 40, "0123456789abcdef" * 4, "A1" * 16],
    "DATE_TIME": [
        "2024-01-31", "2021-04-01T10:00:00Z", "2021-04-01T10:00:00.123456+02:00",
        "2021-04-01 10:00", "31/01/2024", "1.2.2024", "1 April 2021", "April 1, 2021",
        "3rd Sept 1999", "Dec. 24, 2020", "21. May 2003",
    ],
    "STREET_ADDRESS": [
        "1 Main Street", "12 Old Mill Road", "5 Court Street", "7 Church Street North Road",
        "12 rue Victor Hugo", "3 bis avenue des Champs", "8, place de la République",
        "Hauptstraße 5", "Am Lindenweg 12b"[3:],
    ],
}
OTHERS = [
    "bob@", "@bob", "bob@localhost", "a @ b.c", "+1 23", "1 + 2345", "12-34", "1.2.3", "12:30:45",
    "std::vector<int>", "4111 1111 1111", "4222222222223", "378282246310006",
    "de893704004405320130011x", "ab12 with some words", "in 2024 we", "78-051-1200",
    "123e4567-e89b-12d3-a456", "abcdef0123", "2024-1-31", "2021x", "1 Main", "Main Street", "Street 5",
    "May 5", "12 rue de", "www", "",
]


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = flat_candidates(detect(df, "text"), ["id"]).select("id", "label", "text", "start").collect()
    out = {i: [] for i in range(len(texts))}
    for r in rows:
        out[r["id"]].append((r["label"], r["text"], r["start"]))
    return out


def test_values_are_found_whole(spark):
    cases = [(label, v) for label, values in VALUES.items() for v in values]
    texts = [f"(see {v} then)" for _, v in cases]
    got = found(spark, texts)
    for i, (label, v) in enumerate(cases):
        assert got[i] == [(label, v, 5)], (label, v, got[i])


def test_lookalikes_are_not_found(spark):
    got = found(spark, [f"see {v} here" for v in OTHERS])
    assert {OTHERS[i]: hits for i, hits in got.items() if hits} == {}


def test_checksums_raise_the_score(spark):
    df = spark.createDataFrame(
        [("4111111111111111",), ("4111111111111112",), ("DE89370400440532013000",),
         ("DE88370400440532013000",)], "text string")
    rows = flat_candidates(detect(df, "text"), []).select("text", "score").collect()
    assert [r["score"] for r in rows] == [0.99, 0.9, 0.99, 0.9]


def test_gates_are_implied(spark):
    cases = [(label, v) for label, values in VALUES.items() for v in values]
    df = spark.createDataFrame(cases, "label string, text string")
    for d in BUILT_INS:
        own = df.filter(F.col("label") == d.label)
        assert own.filter(~d.gate_column(F.col("text"))).collect() == [], d.label
        assert own.filter(~F.rlike("text", F.lit(ANY_BUILT_IN_GATE))).collect() == []


# For each type, what its repeats repeat.
HARD = {
    "EMAIL_ADDRESS": ["a", "a.", "a@a.", "é@"], "PHONE_NUMBER": ["+1", "+1 2 ", "1-", "0 12 34 "],
    "URL": ["www.", "http://"], "IP_ADDRESS": ["a:", "::", "1.", "a::"], "MAC_ADDRESS": ["00:"],
    "CREDIT_CARD": ["1 ", "1111"], "IBAN_CODE": ["AB12 ", "AB12", "ab12 1234 "], "US_SSN": ["1-"],
    "UUID": ["0000-", "f"], "SECRET_TOKEN": ["f", "F0"],
    "DATE_TIME": ["2024-01-01 10:00:00.", "May 1 ", "1"],
    "STREET_ADDRESS": ["Word ", "1 Main Street ", "1 rue de ", "1 rue Ab", "Aa"],
}


@pytest.mark.parametrize("label", list(HARD))
def test_long_texts_of_each_alphabet_end_well(spark, label):
    """Ten megabytes of each repeat: no stack overflow, and time linear in the text."""
    d = DETECTORS[label]
    lead = {"STREET_ADDRESS": "7 ", "IBAN_CODE": "DE89 "}.get(label, "")
    rows = [(lead + (unit * (10_000_000 // len(unit) + 1))[:10_000_000],) for unit in HARD[label]]
    df = spark.createDataFrame(rows, "text string").repartition(len(rows))
    df.agg(F.sum(F.size(F.regexp_extract_all("text", F.lit(d.pattern), F.lit(0))))).collect()


def test_hostile_rows_do_not_end_the_job(spark):
    texts = ["7 " + "Word " * 5000, "7 " + "Word " * 300_000 + "Street", "+" + "1 " * 3000, "1:" * 50_000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = redact(df, "text").select("redacted_text").collect()
    assert rows[0][0] == texts[0] and rows[1][0] == "[STREET_ADDRESS]"
    assert rows[2][0] == "[PHONE_NUMBER] "


@pytest.mark.parametrize("words,want", [
    ("5 Oak Street", "5 Oak Street"), ("5 Street Street", "5 Street Street"),
    ("5 Oak Way Out", "5 Oak Way"), ("5 Oak Way Out Lane", "5 Oak Way Out Lane"),
    ("5 Oak Streets", None), ("5 Oak Streets Road", "5 Oak Streets Road"), ("5 Street", None),
    ("5 St Ave Rd", "5 St Ave Rd"), ("5 Oak oak Street", None), ("5 Oak Drive-in", "5 Oak Drive"),
])
def test_street_addresses_end_at_their_last_road(spark, words, want):
    hits = sp.Pattern(DETECTORS["STREET_ADDRESS"].pattern, "S", 2).matches(F.lit(words))
    assert spark.range(1).select(hits).first()[0] == ([want] if want else [])


def test_columns_of_internal_names(spark):
    """Internal names cannot clash; a column of an output's name is refused."""
    names = ["__m0", "__hot", "__candidates", "__spans", "__c0", "a`b", "x.y"]
    df = spark.createDataFrame([("mail a@b.com", *names)], ["text", *names])
    done = redact(df, "text")
    assert done.columns[:-4] == df.columns
    row = done.first()
    assert row["redacted_text"] == "mail [EMAIL_ADDRESS]" and [row[n] for n in names] == names
    assert detect(df, "text").first()["__m0"] == "__m0"
    for name in ("entities", "ENTITIES_FOUND", "usage", "redacted_text"):
        with pytest.raises(ValueError, match="columns of the outputs' names"):
            redact(df.withColumn(name, F.lit(1)), "text")


def test_hostile_csv_files(spark):
    from maskwright.plans.folder import redact_csv_text

    wide, cell = ",".join(["name"] * 50_000), "x" * 200_000 + ' "" ' + "a@b.com"
    texts = [
        f'{wide}\n1,a@b.com\n', f'a,b\n"{cell}",2\n', 'a,"b""\nc"\nd@e.com,"f ""g@h.org"""\n',
        '"' + 'a""' * 100_000 + '"\nx', 'h\n"open, a@b.com\nnext', '"' * 200_001, "",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r["id"]: r for r in redact_csv_text(df, "text", RedactOptions()).collect()}
    assert got[0]["redacted_text"] == f"{wide}\n1,[EMAIL_ADDRESS]\n"
    assert got[1]["redacted_text"] == f'a,b\n"{cell[:-7]}[EMAIL_ADDRESS]",2\n'
    assert got[2]["redacted_text"] == 'a,"b""\nc"\n[EMAIL_ADDRESS],"f ""[EMAIL_ADDRESS]"""\n'
    assert got[3]["redacted_text"] == texts[3]
    assert got[4]["redacted_text"] == 'h\n"open, [EMAIL_ADDRESS]\nnext'
    assert got[5]["redacted_text"] == texts[5] and got[6]["redacted_text"] == ""
