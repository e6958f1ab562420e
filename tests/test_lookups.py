"""Tables that meet candidates, shared folders, deep pages, exact percentiles."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskwright import RedactOptions, detect, redact
from maskwright.functions import spans as sp
from maskwright.operators import lookups, pattern_tables
from maskwright.operators.audit import exact_percentile
from maskwright.operators.evaluate import saved_ground_truth
from maskwright.operators.listing import ListQuery, deep_page
from maskwright.operators.registry import upsert
from maskwright.plans.folder import redact_csv_text, unnumbered
from maskwright.sources.shared import shared_dir
from maskwright.sources.tables import redact_columns

SYNTHESIS = RedactOptions(generator_default="Synthesis", key="k")


@pytest.mark.parametrize("hot", [1, 3, 2000])
def test_tables_do_not_need_a_key(spark, monkeypatch, hot):
    """All values by broadcast, some, or none: the result is the same."""
    whole = lookups.value_lookup
    monkeypatch.setattr(
        lookups, "value_lookup", lambda cells, keys, find, value, _: whole(cells, keys, find, value, hot))
    texts = [(None, "a@b.com x"), (1, "c@d.com"), (1, "e@f.com a@b.com"), (1, None), (2, "")]
    df = spark.createDataFrame(texts, "id int, text string")
    swaps = spark.createDataFrame(
        [("EMAIL_ADDRESS", f"{c}@{d}.com", f"{c}.swapped") for c, d in ("ab", "cd", "ef", "gh")]
        + [(None, "x", "y"), ("EMAIL_ADDRESS", None, "y"), ("EMAIL_ADDRESS", "a@b.com", "z")],
        "label string, original string, replacement string",
    )
    got = redact(df, "text", SYNTHESIS, swaps=swaps).select("id", "redacted_text").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [
        (None, "a.swapped x"), (1, "c.swapped"), (1, "e.swapped a.swapped"), (1, None), (2, "")]))
    blocks = swaps.select("label", F.col("original").alias("pattern"))
    found = detect(df, "text", blocks=blocks).select(F.size("spans")).collect()
    assert {r[0] for r in found} <= {0, None, -1}
    words = spark.createDataFrame([("NAME_GIVEN", "x"), ("ORGANIZATION", "x")], "label string, word string")
    row = detect(df.limit(1), "text", RedactOptions(labels=[]), dictionary=words).first()
    assert [(s["label"], s["start"], s["end"]) for s in row["spans"]] == [("NAME_GIVEN", 8, 9)]
    none = swaps.limit(0)
    assert redact(df, "text", SYNTHESIS, swaps=none).count() == 5
    empty = detect(df, "text", RedactOptions(labels=[]), dictionary=words.limit(0))
    assert empty.filter(F.size("spans") > 0).count() == 0


def test_a_value_of_a_third_of_all_spans_is_broadcast(spark):
    """Only values above the bound are broadcast, and the shuffle sees none of them."""
    df = spark.range(3000).selectExpr(
        "concat(if(id % 3 = 0, 'hot', concat('u', id)), '@b.com') AS text").repartition(8)
    swaps = spark.range(3000).selectExpr(
        "'EMAIL_ADDRESS' AS label", "concat('u', id, '@b.com') AS original", "concat('s', id) AS replacement"
    ).unionByName(spark.createDataFrame(
        [("EMAIL_ADDRESS", "hot@b.com", "cool")], "label string, original string, replacement string"))
    done = redact(df, "text", SYNTHESIS, swaps=swaps)
    got = done.groupBy("redacted_text").count().collect()
    assert {r[0]: r[1] for r in got} == {"cool": 1000} | {f"s{i}": 1 for i in range(3000) if i % 3}
    plan = lookups.swapped(lookups.numbered(detect(df, "text")), "spans", swaps)
    assert "LeftAnti" in plan._jdf.queryExecution().optimizedPlan().toString()


def brute_phrases(text, dictionary):
    found = list(re.finditer(r"[^\W_]+", text))
    out = set()
    for label, phrase in dictionary:
        words = re.findall(r"[^\W_]+", phrase)
        for i in range(len(found) - len(words) + 1):
            run = found[i:i + len(words)]
            if words and [m[0] for m in run] == words and all(
                    text[a.end():b.start()].isspace() for a, b in zip(run, run[1:])):
                out.add((run[0].start(), run[-1].end(), label))
    return sorted(out)


@pytest.mark.parametrize("bits", [64, None])
def test_phrases_equal_brute_force(spark, bits):
    """Phrases of one to eight words, overlapping, of several labels; also with a full filter."""
    rng = random.Random(4)
    words = "a b c New York Ünï 日本 x1".split()
    gaps = [" ", " ", "  ", "\n", "-", ", ", "_"]
    texts = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    texts += [None, "", " ", "New York", "word " * 20_000 + "New York"]
    dictionary = [(rng.choice("LMN"), rng.choice([" ", "  ", "-"]).join(
        rng.choice(words) for _ in range(rng.randint(1, 8)))) for _ in range(200)]
    dictionary += [("L", "New York"), ("M", "New York"), ("L", "--"), ("L", None), (None, "a")]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").withColumn(
        "spans", F.array().cast(f"array<{sp.CANDIDATE_TYPE}>"))
    table = spark.createDataFrame(dictionary, "label string, word string")
    got = lookups.dictionary_candidates(
        lookups.numbered(df), "text", "spans", table, bits=bits).select("id", "text", "spans").collect()
    assert len(got) == len(texts)
    listed = [(label, phrase) for label, phrase in dictionary if label and phrase]
    for row in got:
        spans = sorted((s["start"], s["end"], s["label"]) for s in row["spans"])
        assert spans == (brute_phrases(row["text"], listed) if row["text"] else [])
        assert all(row["text"][s["start"]:s["end"]] == s["text"] for s in row["spans"])


def test_the_longest_of_overlapping_phrases_is_found(spark):
    df = spark.createDataFrame([("in New York City Hall, not New-York",)], "text string")
    words = spark.createDataFrame(
        [("A", "New York"), ("B", "York City Hall"), ("C", "New York City"), ("D", "City")],
        "label string, word string")
    found = detect(df, "text", RedactOptions(labels=[]), dictionary=words).first()["spans"]
    # Both three-word phrases are candidates; the longer text wins.
    assert [(s["label"], s["text"]) for s in found] == [("B", "York City Hall")]


@pytest.mark.parametrize("pattern,part", [
    ("abc", "abc"), (r"^User\.12@", "User.12@"), ("ab|cd", ""), ("(?i)abc", ""), ("ab?cd", "cd"),
    ("(?:ab)+c", "ab"), ("x(yz)w", "xyzw"), (r"\d+", ""), ("a(?i:b)cde", "cde"), (r"Order 7 on \d{4}", "Order 7 on "),
    ("a{0}bc", "bc"), ("(?=abc)d", "d"), ("(a|b)xy", "xy"), ("a.b", "a"), ("ab{2,}", "a"),
])
def test_literal_parts_are_in_every_match(pattern, part):
    assert pattern_tables.literal_part(pattern) == part


def test_ten_thousand_patterns(spark):
    """Many patterns from tables; a value that is allowed is not blocked."""
    df = spark.range(3000).selectExpr("id", "concat('mail u', id, '@b.com from 10.0.0.', id % 250) AS text")
    allowed = spark.range(10_000).selectExpr(
        "'PERSON' AS label", r"concat('\\bu', id * 2, '@b') AS pattern")
    blocked = spark.range(10_000).selectExpr(
        "'EMAIL_ADDRESS' AS label", "concat('^u', id * 3, '@') AS pattern").unionByName(
        spark.createDataFrame([("IP_ADDRESS", r"\.(?:7|8)$"), ("PERSON", "u"), (None, "x"), ("URL", None)],
                              "label string, pattern string"))
    got = detect(df, "text", allow_patterns=allowed, block_patterns=blocked).select(
        "id", F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["text"])).alias("s")).collect()
    for r in got:
        i, want = r["id"], []
        if i % 2 == 0:
            want.append(f"PERSON:u{i}@b")
        elif i % 3:
            want.append(f"EMAIL_ADDRESS:u{i}@b.com")
        if i % 250 not in (7, 8):
            want.append(f"IP_ADDRESS:10.0.0.{i % 250}")
        assert r["s"] == want
    with pytest.raises(ValueError, match="empty string"):
        detect(df, "text", block_patterns=allowed.selectExpr("label", "'x*' AS pattern"))
    with pytest.raises(ValueError, match="not a pattern"):
        detect(df, "text", block_patterns=allowed.selectExpr("label", "'(x' AS pattern"))


def test_patterns_without_the_automaton(monkeypatch):
    rows = [("A", "abc"), ("A", "bcd"), ("B", "x|y"), ("A", "zz+")]
    with_it = pattern_tables.Patterns(rows)
    monkeypatch.setattr(pattern_tables, "ahocorasick", None)
    without = pattern_tables.Patterns(rows)
    for text in ("abcd", "xabczzz", "", "q"):
        assert with_it.found(text) == without.found(text)


def test_pools_of_replacements_as_a_table(spark):
    df = spark.createDataFrame([("a@b.com 1.2.3.4",)], "text string")
    pool = spark.createDataFrame(
        [("EMAIL_ADDRESS", i, f"pool{i}") for i in range(5)], "label string, position long, replacement string")
    options = RedactOptions(generator_config={"EMAIL_ADDRESS": "ReplacementSynthesis"}, key="k")
    text = redact(df, "text", options, replacements=pool).first().redacted_text
    assert text.startswith("pool") and text.endswith(" [IP_ADDRESS]")


def test_surrogates_need_a_key():
    with pytest.raises(ValueError):
        RedactOptions(generator_default="Synthesis")


def test_long_values_are_found_whole(spark):
    long = "alice.secret." + "b" * 200 + "@" + "sub." * 100 + "example.com"
    texts = [long, "x" * 200_000 + " a@b.co", "a@b.com_x@c.de", "DE89 3704 0044 0532 0130 00."]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in redact(df, "text").select("redacted_text").collect()] == [
        "[EMAIL_ADDRESS]", "x" * 200_000 + " [EMAIL_ADDRESS]", "[EMAIL_ADDRESS][EMAIL_ADDRESS]",
        "[IBAN_CODE]."]


def test_columns_of_any_name(spark):
    df = spark.createDataFrame([("a@b.com", "1.2.3.4", "x")], "usage string, entities string, `a.b` string")
    row = redact_columns(df).first()
    assert tuple(row) == ("[EMAIL_ADDRESS]", "[IP_ADDRESS]", "x", 2)
    with pytest.raises(ValueError):
        redact_columns(df.withColumn("entities_found", F.lit(1)))


def test_reviewed_files_without_spans_stay(spark):
    batches = spark.createDataFrame(
        [(1, 1, [], True)], "file_id int, batch int, annotations array<struct<start:int,end:int>>, mark_reviewed boolean")
    files = spark.createDataFrame([(1, "text")], "file_id int, content string")
    row = saved_ground_truth(batches, files).first()
    assert row["status"] == "Reviewed" and row["start"] is None and row["error"] is None


def test_upsert_creates_and_never_multiplies(spark):
    rows = spark.createDataFrame([(1, "a", "x")], "id int, name string, kind string")
    new = spark.createDataFrame([(1, "b"), (1, "c"), (2, "n")], "id int, name string")
    assert sorted(map(tuple, upsert(rows, new, "id").collect())) == [(1, "c", "x"), (2, "n", None)]


def test_percentiles_equal_numpy(spark):
    values = [("a", int(v)) for v in np.random.default_rng(1).integers(0, 9000, 500)]
    values += [("b", 7), ("c", 1), ("c", 5000)] + [("d", 3)] * 400
    df = spark.createDataFrame(values, "tool string, ms long")
    got = {r["tool"]: r["percentile"] for r in exact_percentile(df, "tool", "ms", 0.95).collect()}
    for tool in "abcd":
        assert abs(got[tool] - np.percentile([v for t, v in values if t == tool], 95)) < 1e-9


def test_deep_pages_equal_slices(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("k"), "id")
    want = sorted((r["k"], r["id"]) for r in df.collect())
    for offset, limit in ((0, 10), (123, 50), (490, 100), (600, 5), (7, None)):
        got = deep_page(df, [F.asc("k"), F.asc("id")], ListQuery(offset=offset, limit=limit)).collect()
        end = None if limit is None else offset + limit
        assert sorted(map(tuple, got)) == want[offset:end]


def test_output_names_cannot_meet(spark):
    df = spark.createDataFrame([("d/x~2.txt",), ("d/x.txt",), ("d/x~a.txt",)], "p string")
    assert [r[0] for r in df.select(unnumbered(F.col("p"))).collect()] == [
        "d/x~2~1.txt", "d/x.txt", "d/x~a.txt"]


def test_cells_with_quotes_and_other_separators(spark):
    text = 'a,"b\nc",d\n"say ""a@b.com"", ok",x\t1.2.3.4,"plain ""q"""\n'
    df = spark.createDataFrame([(text,)], "text string")
    assert redact_csv_text(df, "text", RedactOptions()).first().redacted_text == (
        'a,"b\nc",d\n"say ""[EMAIL_ADDRESS]"", ok",x\t[IP_ADDRESS],"plain ""q"""\n')


def test_the_shared_folder_is_one_of_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    assert shared_dir(spark).replace("file://", "").startswith(named.replace("file:", ""))


def test_every_label_keeps_its_pool(spark):
    df = spark.createDataFrame([("a@b.com 1.2.3.4",)], "text string")
    pools = spark.createDataFrame(
        [(label, i, f"{label}{i}") for label in ("EMAIL_ADDRESS", "IP_ADDRESS") for i in range(3)],
        "label string, position long, replacement string")
    for hot in (1, 2, 2000):
        rows = lookups.numbered(detect(df, "text"))
        found = lookups.drawn(rows, "spans", pools, "k", hot=hot).first()["spans"]
        assert [s["swap"][:-1] for s in found] == ["EMAIL_ADDRESS", "IP_ADDRESS"]


def test_patterns_are_compiled_when_they_are_tried(spark):
    listed = spark.createDataFrame([("A", "abc[0-9]"), ("A", "xyz+")], "label string, pattern string")
    [block] = pattern_tables.pattern_blocks(listed)
    assert block == [("A", "abc[0-9]", "abc"), ("A", "xyz+", "xy")]
    patterns = pattern_tables.Patterns(block)
    assert not patterns.compiled and [f["text"] for f in patterns.found("abc1")] == ["abc1"]
    assert list(patterns.compiled) == [0]


def test_delimited_files_are_read_by_all_slots(spark, tmp_path, monkeypatch):
    from maskwright.sources import tables

    monkeypatch.setattr(tables, "FILE_ROWS", 10)
    rows = spark.range(0, 95, 1, 1).selectExpr("id", "'a\nb' AS text")
    tables.write_delimited(rows, f"{tmp_path}/many")
    assert len(list((tmp_path / "many").glob("*.csv"))) == 10
    rows.coalesce(1).write.option("header", "true").option("escape", '"').csv(f"{tmp_path}/one")
    for name in ("many", "one"):
        read = tables.read_delimited(spark, f"{tmp_path}/{name}")
        assert read.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        assert sorted(int(r.id) for r in read.collect()) == list(range(95))
        assert {r.text for r in read.collect()} == {"a\nb"}


def test_the_dictionary_holds_words_of_any_frequency(spark, tmp_path):
    from maskwright.queries import QUERIES

    texts = ["common"] * 30 + ["rare common", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.entities_found for r in QUERIES["r23_dictionary_table"](spark, str(tmp_path)).collect()}
    assert got == {i: 1 for i in range(30)} | {30: 2}


def test_phrases_keep_the_white_space_of_their_text(spark):
    texts = ["Big \n Apple, big Big Apple", "Apple Apple", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    words = spark.createDataFrame(
        [("ORGANIZATION", "Big  Apple"), ("NAME_FAMILY", "Apple"), ("ORGANIZATION", "Apple")], "label string, word string")
    found = detect(df, "text", RedactOptions(labels=[]), dictionary=words)
    # Values come along with their places; none is cut out of the whole text again.
    assert "substring(" not in found._jdf.queryExecution().analyzed().toString()
    got = {r.id: [(c.start, c.end, c.label, c.text) for c in r.spans] for r in found.collect()}
    assert got == {
        0: [(0, 11, "ORGANIZATION", "Big \n Apple"), (17, 26, "ORGANIZATION", "Big Apple")],
        1: [(0, 5, "NAME_FAMILY", "Apple"), (6, 11, "NAME_FAMILY", "Apple")], 2: [], 3: [],
    }


def test_patterns_meet_texts_by_their_literal_parts(spark, monkeypatch):
    """No block is handed out for patterns with a literal part, and all occurrences are found."""
    monkeypatch.setattr(pattern_tables, "_finder", None)
    monkeypatch.setattr(pattern_tables, "_blocker", None)
    draw = random.Random(5)
    texts = ["".join(draw.choices(["ab", "b", "ü", "\U0001f600", "x1", " ", "u7@b.co"], k=draw.randint(0, 12))) for _ in range(60)]
    rows = [("P", "ab+x"), ("Q", "b{2}"), ("P", "ü.?ü"), ("R", "\U0001f600x"), ("R", "x1 ?ab"), ("P", "ab+x"),
            ("Q", "nowhere"), ("R", r"x1|b(?<=ab)x"[:2])]
    listed = spark.createDataFrame([*rows, (None, "a"), ("P", None)], "label string, pattern string")
    df = spark.createDataFrame([*enumerate(texts), (None, "abx"), (0, None)], "id int, text string")
    placed = lookups.numbered(df.withColumn("spans", sp.empty_candidates()))
    got = pattern_tables.forced(placed, "text", "spans", listed).collect()
    assert len(got) == len(texts) + 2
    for row in got:
        want = sorted({(m.start(), m.end(), label, m[0]) for label, p in rows for m in re.finditer(p, row.text or "")})
        assert sorted((s["start"], s["end"], s["label"], s["text"]) for s in row.spans) == want
    blocked = spark.createDataFrame(
        [("EMAIL_ADDRESS", "u7@"), ("URL", "ab"), ("EMAIL_ADDRESS", "^abu")], "label string, pattern string")
    left = detect(df, "text", block_patterns=blocked).select("text", F.col("spans.text").alias("s")).collect()
    kept = {r.text: r.s for r in detect(df, "text").select("text", F.col("spans.text").alias("s")).collect()}
    assert all(r.s == [v for v in kept[r.text] or [] if "u7@" not in v] for r in left if r.text is not None)


def test_literal_parts_in_texts_do_not_cross_them():
    windows = pattern_tables._Windows("abcab")
    assert windows.hashes(2)[0] == windows.hashes(2)[3] != windows.hashes(2)[1] and len(windows.hashes(9)) == 0
    every = np.full(4, np.uint64(2**64 - 1))
    assert pattern_tables._parts_in(["ab", None, "", "\U0001f600c"], every, [1, 2, 3]) == {
        (0, "a"), (0, "b"), (0, "ab"), (3, "\U0001f600"), (3, "c"), (3, "\U0001f600c")}


def test_a_phrase_leaves_its_text_once(spark, monkeypatch):
    """A word that a text holds many times is one row on its way to the dictionary."""
    rows = []
    whole = lookups.value_lookup

    def counted(cells, *rest):
        rows.append(cells.count())
        return whole(cells, *rest)

    monkeypatch.setattr(lookups, "value_lookup", counted)
    text = "ab cd  ef " * 50 + "ab cd ef"
    df = spark.createDataFrame([(1, text), (None, "ab"), (2, None), (3, "")], "id int, text string")
    words = spark.createDataFrame(
        [("A", "ab"), ("B", "ab"), ("A", "cd ef"), ("B", "xx")], "label string, word string")
    found = detect(df, "text", RedactOptions(labels=[]), dictionary=words)
    got = {r.id: r.spans for r in found.select("id", "spans").collect()}
    assert rows == [3]
    want = sorted([(m.start(), m.end(), "A", m[0]) for m in re.finditer(r"ab|cd\s+ef", text)])
    assert [(s["start"], s["end"], s["label"], s["text"]) for s in got[1]] == want
    assert [s["text"] for s in got[None]] == ["ab"] and not got[2] and not got[3]
