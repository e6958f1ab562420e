"""Structured texts, path rules, folder jobs, registries and evaluation on small cases."""

import json
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from maskwright import LabelList, RedactOptions
from maskwright.functions.jsonpath import to_regex
from maskwright.functions.text import extension, normalize_duration
from maskwright.operators import evaluate as ev
from maskwright.operators.listing import Listing, ListQuery, page
from maskwright.operators.models import token_features, train, training_rows
from maskwright.operators.ordinals import ordinal_within
from maskwright.operators.redact import flat_candidates, detect
from maskwright.operators.detectors import register_detector
from maskwright.operators.registry import jobs_since
from maskwright.operators.structured import json_leaf_table, redact_html, redact_json, redact_xml
from maskwright.plans.folder import FolderOptions, deidentify_folder, plan_work, redacted_name, with_outputs
from maskwright.sources.files import list_tree, read_whole, write_tree
from maskwright.sources.shared import stored


def one(spark, text, fn, **kwargs):
    return fn(spark.createDataFrame([(text,)], "t string"), "t", **kwargs).first()


def test_json_keeps_structure(spark):
    text = '{"b": 2.50, "a":["x 1.2.3.4 \\u00e9 \\"q\\"",{"a":1,"a":"a@b.com"}],\t"e":{}, "n":null}'
    row = one(spark, text, redact_json)
    assert row.redacted_text == (
        '{"b": 2.50, "a":["x [IP_ADDRESS] é \\"q\\"",{"a":1,"a":"[EMAIL_ADDRESS]"}],\t"e":{}, "n":null}'
    )
    assert [e.json_path for e in row.entities] == ["$.a[0]", "$.a[1].a"]
    json.loads(row.redacted_text)


@pytest.mark.parametrize("text", ["{", "[1,]", '{"a" 1}', "NaN", "", "[1] 2", '"\n"'])
def test_malformed_json_is_withheld(spark, text):
    row = one(spark, text, redact_json)
    assert row.status == "error" and row.redacted_text is None and "malformed" in row.error


@pytest.mark.parametrize(
    "path, hits, misses",
    [
        ("$.id", ["$.id", "$.id.x", "$.id[0]"], ["$.idx", "$.a.id"]),
        ("$[*].id", ["$[0].id", "$.a.id"], ["$.id"]),
        ("$..ts", ["$.ts", "$.a[3].ts.x"], ["$.a.tsx"]),
        ("$['a b'].c", ["$['a b'].c"], ["$.a.c"]),
        ("$.*", ["$.a", "$[0]"], ["$"]),
        ("$.a[2]", ["$.a[2]", "$.a[2].b"], ["$.a[22]"]),
    ],
)
def test_json_paths(spark, path, hits, misses):
    df = spark.createDataFrame([(p,) for p in hits + misses], "p string")
    got = {r.p for r in df.filter(F.rlike("p", F.lit(to_regex(path)))).collect()}
    assert got == set(hits)


def test_xml_and_html_cases(spark):
    row = one(spark, "<a x='it&apos;s 1.2.3.4'>&lt;a@b.com&gt;<!--1.2.3.4--></a>", redact_xml)
    assert row.redacted_text == "<a x='it&apos;s [IP_ADDRESS]'>&lt;[EMAIL_ADDRESS]&gt;<!--1.2.3.4--></a>"
    assert one(spark, "<a>", redact_xml).status == "error"
    assert one(spark, "<!DOCTYPE a [<!ENTITY b 'c'>]><a>&b;</a>", redact_xml).status == "error"
    html = '<p title="a@b.com">a&amp;b &quot;a@b.com&quot;</p><script>"</p>1.2.3.4"</script> a < b'
    assert one(spark, html, redact_html).redacted_text == (
        '<p title="a@b.com">a&amp;b &quot;[EMAIL_ADDRESS]&quot;</p><script>"</p>1.2.3.4"</script> a < b'
    )


def test_names_and_extensions(spark):
    names = [".bashrc", "a.tar.gz", "a.", "X.JSON", "none"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(extension(F.col("n"))).collect()] == ["", ".gz", ".", ".JSON", ""]
    options = RedactOptions(
        generator_default="Synthesis", key="test key",
        label_allow_lists={"NAME_GIVEN": LabelList(["Dad"]), "PHONE_NUMBER": LabelList(regexes=[r"\d{11}"])},
    )
    name = spark.range(1).select(redacted_name(F.lit("Dad_15084238708.txt"), options)).first()[0]
    assert "Dad" not in name and "15084238708" not in name and name.endswith(".txt") and "_" in name


def test_durations(spark):
    raw = ["30m", "90m", "36h", "7d", "01:00:00", "abc", "45S"]
    df = spark.createDataFrame([(r,) for r in raw], "r string")
    assert [r[0] for r in df.select(normalize_duration(F.col("r"))).collect()] == [
        "00:30:00", "01:30:00", "1.12:00:00", "7.00:00:00", "01:00:00", "abc", "00:00:45"
    ]
    with pytest.raises(ValueError):
        jobs_since(df, "soon", F.lit(None))


def test_folder_job(spark, tmp_path):
    tree = {
        "in put/x.txt": "mail a@b.com", "in put/x.log": "a@b.com", "n/a@b.com.json": '{"a":"1.2.3.4"}',
        "n/c@d.com.json": '{"a":1}', "n/bad.json": "{", "p.HTML": "<p>1.2.3.4</p>",
        "q.xml": "<a b='1.2.3.4'/>", "r.csv": 'id,a@b.com\n1,"x, 1.2.3.4"\n', "i.png": "?",
        "node_modules/d/y.txt": "z",
    }
    for path, text in tree.items():
        target = tmp_path / "src" / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(text)
    job = deidentify_folder(
        spark, str(tmp_path / "src"), RedactOptions(generator_default="Redaction"),
        FolderOptions(deidentify_names=True, skip_patterns=["node_modules", "*.log"]),
    )
    outputs = {r.output_path: r.redacted_text for r in job.outputs.collect()}
    assert outputs == {
        "in put/x.txt": "mail [EMAIL_ADDRESS]", "n/[EMAIL_ADDRESS].json": '{"a":"[IP_ADDRESS]"}',
        "n/[EMAIL_ADDRESS]~2.json": '{"a":1}', "p.HTML": "<p>[IP_ADDRESS]</p>",
        "q.xml": "<a b='[IP_ADDRESS]'/>", "r.csv": 'id,a@b.com\n1,"x, [IP_ADDRESS]"\n',
    }
    skipped = {r.source: r.error for r in job.results.filter("status = 'skipped'").collect()}
    assert set(skipped) == {"in put/x.log", "node_modules", "i.png"}
    assert job.summary.first().asDict() == {
        "total_files": 7, "total_processed": 10, "succeeded": 6, "failed": 1, "skipped": 3
    }
    write_tree(job.outputs, str(tmp_path / "out"))
    assert (tmp_path / "out/n/[EMAIL_ADDRESS]~2.json").read_text() == '{"a":1}'
    assert list_tree(spark, str(tmp_path / "src"), max_depth=0).count() == 4
    assert not os.path.exists(tmp_path / "out/n/bad.json")


def test_ordinals_of_hot_groups(spark):
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 7) END AS k",
        "lpad(cast((id * 37) % 3000 AS string), 5, '0') AS o",
    )
    want = df.withColumn("w", F.row_number().over(Window.partitionBy("k").orderBy("o")))
    got = ordinal_within(df, "k", "o", hot_rows=200).join(want, ["k", "o"])
    assert got.count() == 3000 and got.filter("ordinal <> w").count() == 0


def test_collisions_are_numbered_by_source(spark):
    files = spark.createDataFrame([("d/b@x.org.txt",), ("d/a@x.org.txt",), ("d/z.txt",)], "path string")
    work = plan_work(files, RedactOptions(generator_default="Redaction"), FolderOptions(deidentify_names=True))
    got = {r.path: r.output_path for r in with_outputs(work).collect()}
    assert got == {
        "d/a@x.org.txt": "d/[EMAIL_ADDRESS].txt", "d/b@x.org.txt": "d/[EMAIL_ADDRESS]~2.txt", "d/z.txt": "d/z.txt",
    }


def test_span_scores(spark):
    schema = "file_id int, start int, end int"
    gold = spark.createDataFrame([(1, 0, 10), (1, 300, 900), (2, 0, 5)], schema)
    pred = spark.createDataFrame([(1, 0, 4), (1, 5, 9), (1, 899, 905), (1, 950, 960), (3, 0, 1)], schema)
    got = {r.file_id: r for r in ev.scores(ev.overlap_counts(pred, gold)).collect()}
    assert (got[1].predicted, got[1].pred_hits, got[1].gold, got[1].gold_hits) == (4, 3, 2, 2)
    assert got[1].precision_score == 0.75 and got[1].recall_score == 1.0
    assert got[2].precision_score is None and got[2].recall_score == 0.0 and got[2].f1_score is None
    assert got[3].recall_score is None


def test_paging_rules(spark):
    df = spark.range(10).selectExpr("id", "concat('n', id % 2) AS name")
    listing = Listing(key="id", search="name", sortable=["name"])
    ids = [r.id for r in page(df, listing, ListQuery(sort_by="name", offset=3, limit=4)).collect()]
    assert ids == [6, 8, 1, 3]
    assert page(df, listing, ListQuery(offset=50)).count() == 0
    assert page(df, listing, ListQuery(search="   ")).count() == 10
    for bad in ({"offset": -1}, {"limit": 0}, {"sort_direction": "up"}):
        with pytest.raises(ValueError):
            ListQuery(**bad)
    with pytest.raises(ValueError):
        page(df, listing, ListQuery(sort_by="secret"))


def test_trained_detector_learns(spark):
    texts = [(i, f"ticket{i} opened by agent K{i:03d} today for room{i}") for i in range(60)]
    files = spark.createDataFrame(texts, "file_id int, content string")
    spans = spark.createDataFrame(
        [(i, t.index("K"), t.index("K") + 4) for i, t in texts], "file_id int, start int, end int"
    )
    register_detector("agents", train(files, spans, "AGENT").detector())
    fresh = spark.createDataFrame([("call opened by agent K777 today", )], "text string")
    got = flat_candidates(detect(fresh, "text", RedactOptions(custom_entities=["agents"])), []).collect()
    assert [(g.label, g.text) for g in got] == [("AGENT", "K777")]


def test_equal_tokens_are_trained_on_once(spark):
    text = "écrit K007 ou İ K007"
    files = spark.createDataFrame(
        [(i, text) for i in range(30)] + [(1, None), (2, ""), (None, "K007")], "file_id int, content string")
    spans = spark.createDataFrame([(i, 6, 8) for i in range(10)] + [(0, 9, 10)], "file_id int, start int, end int")
    rows = training_rows(files, spans).collect()
    # Five tokens, the second one with either target, and a lone one.
    assert len(rows) == 7 and sum(r.n for r in rows) == 151
    assert sorted(r.n for r in rows if r.target == 1) == [10]
    assert all(r.vector["indices"] == sorted(set(r.vector["indices"])) for r in rows)
    tokens = spark.createDataFrame([(["écrit", "K007", "ou", "İ", "K007"],)], "t array<string>")
    want = {tuple(f) for f in tokens.select(token_features(F.col("t"))).first()[0]}
    assert want <= {tuple(r.vector["indices"]) for r in rows}


def test_empty_files_are_files(spark, tmp_path):
    texts = {"a/x.txt": "mail a@b.com", "a/em+pty %41.txt": "", "b/c/empty.json": "", "é.log": ""}
    for path, text in texts.items():
        target = tmp_path / "src" / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(text)
    root = str(tmp_path / "src")
    sizes = {r["path"]: (r["size"], r["depth"]) for r in list_tree(spark, root).collect()}
    assert sizes == {p: (len(t), p.count("/")) for p, t in texts.items()}
    contents = read_whole(spark, root).collect()
    assert {r["path"]: r["text"] for r in contents} == texts and len(contents) == 4
    job = deidentify_folder(
        spark, root, RedactOptions(generator_default="Redaction"), FolderOptions(skip_patterns=["*.log"])
    )
    outputs = {r["path"]: (r["redacted_text"], r["entities_found"]) for r in job.outputs.collect()}
    assert outputs["a/em+pty %41.txt"] == ("", 0)
    results = {r["source"]: r["status"] for r in job.results.collect()}
    assert set(results) == set(texts) and results["é.log"] == "skipped"
    summary = job.summary.first()
    assert summary["total_processed"] == 4 and summary["skipped"] == 1


def test_failed_and_repeated_tasks_leave_each_file_once(spark, tmp_path, monkeypatch):
    """Attempts write under names of their own; what lost attempts wrote is gone."""
    from maskwright.sources import files

    root, twice = str(tmp_path / "out"), []

    def again(df, name, by=()):
        # The staging pass runs twice, as for a task that is repeated; one result wins.
        twice.append(df.collect())
        return stored(df, name, by)

    monkeypatch.setattr(files, "stored", again)
    rows = [(f"d{i % 3}/f {i}%41.txt", f"text {i} é\r\n") for i in range(40)] + [("e.txt", ""), ("n.txt", None)]
    outputs = spark.createDataFrame(rows, "output_path string, redacted_text string").repartition(5)
    write_tree(outputs, f"file://{root}")
    write_tree(outputs, root)
    assert len(twice) == 2 and len(twice[0]) == 42
    got = {os.path.relpath(os.path.join(d, f), root): open(os.path.join(d, f), newline="").read()
           for d, _, names in os.walk(root) for f in names}
    assert got == {path: text or "" for path, text in rows}
    with pytest.raises(Exception, match="leaves the output directory"):
        write_tree(spark.createDataFrame([("a/../../x", "t")], outputs.schema), root)
    assert sorted(os.listdir(root)) == ["d0", "d1", "d2", "e.txt", "n.txt"]


def test_a_move_that_was_done_before_is_no_fault(spark, tmp_path, monkeypatch):
    from maskwright.sources import files

    def moved_once(df, name, by=()):
        done = stored(df, name, by)
        first = done.first()
        target = tmp_path / "out" / first["target"]
        os.rename(first["staged"], target)
        return done

    monkeypatch.setattr(files, "stored", moved_once)
    rows = [("a.txt", "1"), ("b.txt", "2")]
    write_tree(spark.createDataFrame(rows, "output_path string, redacted_text string"), str(tmp_path / "out"))
    assert {f: (tmp_path / "out" / f).read_text() for f in os.listdir(tmp_path / "out")} == dict(rows)


def test_trees_are_listed_by_tasks(spark, tmp_path):
    """Odd names, depths, hidden names and empty folders; no path passes the driver."""
    names = ["a/b/c/d/e.txt", "a/x y%41+é.txt", "a/b/z.txt", "top.txt", "a/.hidden", "_skip/x.txt", "q#?/r.txt"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    (tmp_path / "empty").mkdir()
    seen = [n for n in names if "hidden" not in n and "_skip" not in n]
    for root in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}/"):
        assert {r["path"]: r["size"] for r in list_tree(spark, root, None).collect()} == {
            n: len(n.encode()) for n in seen}
        assert {r["path"]: r["text"] for r in read_whole(spark, root).collect()} == {n: n for n in seen}
    for depth in range(5):
        assert {r["path"] for r in list_tree(spark, str(tmp_path), depth).collect()} == {
            n for n in seen if n.count("/") <= depth}
    with pytest.raises(ValueError):
        list_tree(spark, str(tmp_path), -1)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad/x.txt").write_bytes(b"a\xffb")
    assert read_whole(spark, str(tmp_path / "bad")).first()["text"] == "a\ufffdb"


def test_documents_reach_python_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    df = spark.createDataFrame([('{"a": "b@c.de"}',)], "j string")
    for run in (lambda: redact_json(df, "j"), lambda: json_leaf_table(df, [], "j")):
        spark.conf.set(name, "10000")
        assert run().count() == 1 and int(spark.conf.get(name)) <= 2048
