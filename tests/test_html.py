"""The HTML tokeniser against a state machine written after the HTML standard."""

import random
import re

import pytest
from maskwright.operators.structured import html_token_table, html_tokens, redact_html
from pyspark.sql import functions as F

SPACE = "\t\n\f\r "
CODE = ("script", "style")
TEXT = ("title", "textarea", "xmp", "iframe", "noembed", "noframes")


def tag_end(s, i):
    """The index after the tag whose name begins at i, or None if the text ends before."""
    n = len(s)
    while i < n and s[i] not in SPACE + "/>":
        i += 1
    state, quote = "before name", ""
    while i < n:
        c = s[i]
        if state == "before name":
            if c == ">":
                return i + 1
            if c not in SPACE + "/":
                state = "name"
        elif state == "name":
            if c == ">":
                return i + 1
            if c in SPACE:
                state = "after name"
            elif c == "/":
                state = "before name"
            elif c == "=":
                state = "before value"
        elif state == "after name":
            if c == ">":
                return i + 1
            if c == "=":
                state = "before value"
            elif c == "/":
                state = "before name"
            elif c not in SPACE:
                state = "name"
        elif state == "before value":
            if c == ">":
                return i + 1
            if c in "\"'":
                state, quote = "quoted", c
            elif c not in SPACE:
                state = "unquoted"
        elif state == "quoted":
            if c == quote:
                state = "before name"
        elif state == "unquoted":
            if c == ">":
                return i + 1
            if c in SPACE:
                state = "before name"
        i += 1
    return None


def name_at(s, i):
    return re.match(r"[^\t\n\f\r />]*", s[i:])[0].lower()


def close_of(s, i, name):
    """The index of the end tag of an element whose content begins at i."""
    m = re.compile(rf"</{name}(?=[\t\n\f\r />])", re.I).search(s, i)
    return m.start() if m else None


def reference(s):
    """[(raw, is_text)] with text runs joined."""
    out, i, n = [], 0, len(s)

    def put(raw, is_text):
        if raw and is_text and out and out[-1][1]:
            out[-1] = (out[-1][0] + raw, True)
        elif raw:
            out.append((raw, is_text))

    while i < n:
        if s[i] != "<" or i + 1 == n or not re.match(r"[A-Za-z/!?]", s[i + 1]):
            put(s[i], True)
            i += 1
            continue
        end, text = None, None
        if s.startswith("<!--", i):
            m = re.compile(r"-?>").match(s, i + 4) or re.compile(r"--!?>").search(s, i + 4)
            end = m.end() if m else None
        elif s[i + 1] in "!?" or s[i + 1] == "/" and not re.match("[A-Za-z]", s[i + 2:i + 3]):
            at = s.find(">", i + 2)
            end = at + 1 if at >= 0 else None
        elif s[i + 1] == "/":
            end = tag_end(s, i + 2)
        else:
            end, name = tag_end(s, i + 1), name_at(s, i + 1)
            if end is not None and name in CODE:
                at = close_of(s, end, name)
                end = tag_end(s, at + 2) if at is not None else None
            elif end is not None and name in TEXT:
                at = close_of(s, end, name)
                text = s[end:] if at is None else s[end:at]
        if end is None:
            put(s[i:], True)
            break
        put(s[i:end], False)
        i = end
        if text:
            put(text, True)
            i += len(text)
    return out


def joined(tokens):
    out = []
    for raw, is_text in tokens:
        if is_text and out and out[-1][1]:
            out[-1] = (out[-1][0] + raw, True)
        else:
            out.append((raw, is_text))
    return out


ODD = [
    "if a < b mail x@y.com <b>", "<a title='>x'>t</a>", '<a b="1>2" c=\'3>4\'>t', "<!-- a > b -->t",
    "<!-->t", "<!--->t", "<!-- x --!>t", "<!-- open x@y.com", "<a href='open x@y.com>", "<a open",
    "<script>if (a < b) '</p>'</script >t", "<SCRIPT>x</style></Script\n>t", "<script>open x@y.com",
    "<script/>x</script>t", "<style>a>b</style>t", "<title>a <b> x@y.com</title>t", "<textarea><x@y.com></textarea>",
    "</>t", "</ x>t", "</", "<", "<>", "a<3 b", "<?xml ?>t", "<!doctype html>t", "<![CDATA[x]]>t", "<!",
    "<a/b/c=d/e>t", "<a = b>t", "<a b = >t", "<a b= 'c'd>t", "<a\n\tb\f=\"c\">", "<title>", "<title x='>'>a</titles></title>",
    "", "plain", "<a b=c'd>e", "<script><!--<script></script>--></script>", "<a b=\"c\"/>t",
]


def told(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, html string")
    rows = df.select("id", html_tokens(F.col("html")).alias("t")).collect()
    return {r["id"]: [(t["raw"], t["is_text"]) for t in r["t"]] for r in rows}


def test_odd_texts_are_read_as_the_standard_says(spark):
    for i, tokens in told(spark, ODD).items():
        assert "".join(raw for raw, _ in tokens) == ODD[i]
        assert joined(tokens) == reference(ODD[i]), ODD[i]


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_are_read_as_the_standard_says(spark, seed):
    rng = random.Random(seed)
    parts = ["<", ">", "/", "!", "-", "--", "?", "=", "\"", "'", " ", "\n", "a", "b=c", "</", "<!--", "-->",
             "<a ", "<script>", "</script>", "<title>", "</title", "<style ", "</STYLE>", "é", "x@y.com", "<textarea>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(3000)]
    for i, tokens in told(spark, texts).items():
        assert "".join(raw for raw, _ in tokens) == texts[i]
        assert joined(tokens) == reference(texts[i]), texts[i]


def test_no_address_stays_outside_markup(spark):
    df = spark.createDataFrame([
        (1, "if a < b mail x@y.com <b>"), (2, "<p title=\"x@y.com\">x@y.com"), (3, "<b mail x@y.com"),
        (4, "<title>x@y.com <i></title>"), (5, "<!-- x@y.com"), (6, None), (7, "<script>x@y.com</script>x@y.com"),
    ], "id int, html string")
    got = {r["id"]: r["redacted_text"] for r in redact_html(df, "html").collect()}
    assert got == {
        1: "if a < b mail [EMAIL_ADDRESS] <b>", 2: "<p title=\"x@y.com\">[EMAIL_ADDRESS]",
        3: "<b mail [EMAIL_ADDRESS]", 4: "<title>[EMAIL_ADDRESS] <i></title>", 5: "<!-- [EMAIL_ADDRESS]",
        6: None, 7: "<script>x@y.com</script>[EMAIL_ADDRESS]",
    }
    assert html_token_table(df, ["id"], "html").filter("id = 7").count() == 1


def test_long_pages_end_well(spark):
    """Megabytes of one piece: linear time, no recursion."""
    parts = ["<a ", "<a b='", "<script>", "<title>", "<!--", "<!", "</", "<", "< ", "<a b=c ", "a='b' ", "<b>x</b>"]
    rows = [(i, (p * (2_000_000 // len(p) + 1))) for i, p in enumerate(parts)]
    rows += [(100, "<a " + "b='c' " * 300_000 + ">t"), (101, "<a " + "b " * 900_000)]
    df = spark.createDataFrame(rows, "id int, html string").repartition(7)
    sizes = df.select("id", F.length("html").alias("n"), F.regexp_extract_all(
        "html", F.lit(_token()), F.lit(0)).alias("t")).select(
        "id", "n", F.aggregate("t", F.lit(0), lambda a, t: a + F.length(t)).alias("m"))
    assert all(r["n"] == r["m"] for r in sizes.collect())


def _token():
    from maskwright.operators.structured import HTML_TOKEN

    return HTML_TOKEN
