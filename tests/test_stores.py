"""Spans kept by content, and registries with snapshots."""

import random

import pytest
from maskwright import LabelList, RedactOptions, detect
from maskwright.operators.projections import trained_models, version_files, version_summaries
from maskwright.operators.snapshots import SnapshotRegistry
from maskwright.operators.span_store import SpanStore, detector_version
from pyspark.sql import functions as F


def test_only_changed_texts_and_versions_are_scanned(spark, tmp_path):
    store = SpanStore(spark, str(tmp_path / "spans"))
    rows = [(1, "a@b.com"), (1, "a@b.com"), (None, "x 1.2.3.4"), (3, None), (4, ""), (5, "none")]
    df = spark.createDataFrame(rows, "id int, text string").withColumn("content", F.lit("clash"))
    first = store.predict(df, "text", run=1)
    assert first.scanned == 4 and first.rows.columns == ["id", "text", "content", "spans"]
    want = sorted(map(str, detect(df, "text").collect()))
    assert sorted(map(str, first.rows.collect())) == want
    again = store.predict(df, "text", run=2)
    assert again.scanned == 0 and sorted(map(str, again.rows.collect())) == want
    more = df.unionByName(spark.createDataFrame([(6, "c@d.com", "z"), (7, "a@b.com", "z")], df.schema))
    assert store.predict(more, "text", run=3).scanned == 1
    forced = store.predict(more, "text", run=4, force=True)
    assert forced.scanned == 5 and forced.rows.count() == 8
    # Another version is scanned apart; the first one is still known.
    options = RedactOptions(labels=["IP_ADDRESS"])
    other = store.predict(df, "text", options, run=5)
    assert other.scanned == 4
    assert sum(len(r["spans"] or []) for r in other.rows.collect()) == 1
    assert store.predict(df, "text", run=6).scanned == 0
    assert store.predict(df.limit(0), "text", run=7, force=True).scanned == 0
    with pytest.raises(ValueError):
        store.predict(df.withColumn("spans", F.lit(1)), "text", run=8)


def test_versions_depend_on_what_detection_depends_on():
    versions = [
        detector_version(RedactOptions()), detector_version(RedactOptions(labels=["URL"])),
        detector_version(RedactOptions(label_allow_lists={"URL": LabelList(["x"])})),
        detector_version(RedactOptions(label_block_lists={"URL": LabelList(["x"])})),
        detector_version(RedactOptions(), custom="2"),
    ]
    assert len(set(versions)) == 5
    assert detector_version(RedactOptions(generator_default="Off")) == versions[0]


def test_snapshots_equal_the_replay(spark, tmp_path):
    """Late, repeated and deleting events, null keys, and batches that are written again."""
    rng, n = random.Random(6), 0
    frame = spark.createDataFrame([], "key string, kind int, at int, seq int, value string, deleted boolean")
    registry = SnapshotRegistry(str(tmp_path / "r"), frame.schema, ["key", "kind"], ["at", "seq"])
    assert registry.current(spark).collect() == []
    registry.compact(spark)
    for batch in range(6):
        rows = []
        for _ in range(rng.choice([0, 5, 60])):
            n += 1
            rows.append((rng.choice(["a", "b", "c", None]), rng.choice([1, 2, 3, None]), rng.randint(0, 30), n,
                         f"v{n}", rng.choice([True, False, False, None])))
        registry.append(spark.createDataFrame(rows, frame.schema), batch)
        registry.append(spark.createDataFrame(rows, frame.schema), batch)
        now = sorted(map(str, registry.current(spark).collect()))
        assert now == sorted(map(str, registry.replay(spark).collect()))
        if batch in (1, 2, 4):
            registry.compact(spark)
            assert sorted(map(str, registry.current(spark).collect())) == now
    assert len(now) > 3


def test_the_state_reads_the_snapshot_and_newer_batches_only(spark, tmp_path):
    frame = spark.range(100).selectExpr("id AS key", "id AS at", "false AS deleted")
    registry = SnapshotRegistry(str(tmp_path / "r"), frame.schema, ["key"], ["at"])
    for batch in range(3):
        registry.append(frame, batch)
    registry.compact(spark)
    registry.append(frame.filter("key < 3").withColumn("at", F.col("at") + 1000), 3)
    files = " ".join(registry.current(spark).inputFiles())
    assert "upto=2" in files and "__batch=3" in files
    assert not any(f"__batch={b}" in files for b in range(3))
    assert registry.current(spark).filter("at >= 1000").count() == 3
    # A snapshot or batch that was not finished does not count.
    (tmp_path / "r/snapshots/upto=9").mkdir()
    assert registry.current(spark).count() == 100


def test_models_and_versions_without_files(spark):
    """Counts are 0 and scores NULL without files; one entity or one model can be asked for."""
    models = spark.createDataFrame(
        [("m1", 1, "e", "v", "Ready"), ("m2", 2, "e", "v", "Training"), ("m3", 1, "f", "w", "Failed")],
        "id string, number int, entity_id string, version_id string, status string")
    counts = "status string, num_entities int, predicted int, gold int, pred_hits int, gold_hits int"
    files = spark.createDataFrame(
        [("m1", "Ready", 3, 4, 2, 2, 2), ("m1", "Failed", None, 0, 2, 0, 0), ("m2", "Ready", 0, 0, 0, 0, 0)],
        f"model_id string, {counts}")
    activations = spark.createDataFrame(
        [("e", "m2", 1, 1), ("e", "m1", 2, 2), ("g", "m9", 1, 3)],
        "entity_id string, model_id string, at int, event_id int")
    got = {r["model_id"]: r for r in trained_models(models, files, activations).collect()}
    assert {k: (r["is_active"], r["progress"], r["entity_count"], r["file_count"]) for k, r in got.items()} == {
        "m1": (True, 0.5, 3, 2), "m2": (False, 1.0, 0, 1), "m3": (False, None, 0, 0)}
    assert got["m1"]["benchmark_score"] == 0.5 and got["m2"]["benchmark_score"] is None
    assert trained_models(models, files, activations, entity_id="f").count() == 1
    one = trained_models(models, files, activations, entity_id="e", model_id="m2").collect()
    assert [r["model_id"] for r in one] == ["m2"]
    versions = spark.createDataFrame(
        [("m1", "e", 1, "Ready", "g", None, None), ("x", "e", 2, "Failed", "g", "T", "d")],
        "id string, entity_id string, version_number int, status string, guidelines string, "
        "error_type string, error_details string")
    own = files.withColumnRenamed("model_id", "version_id")
    plain = version_summaries(versions, own)
    assert plain.columns[-2:] == ["error_type", "error_details"] and "guidelines" not in plain.columns
    rows = {r["version_id"]: r for r in version_summaries(versions, own, guidelines=True, errors=False).collect()}
    assert (rows["m1"]["file_count"], rows["m1"]["f1_score"], rows["m1"]["guidelines"]) == (2, 0.5, "g")
    assert (rows["x"]["file_count"], rows["x"]["entity_count"], rows["x"]["f1_score"]) == (0, 0, None)
    named = own.withColumns({"file_id": F.lit(1), "file_name": F.lit("f")})
    assert version_files(named, errors=False).filter("f1_score IS NOT NULL").count() == 1


def test_predictions_write_no_texts(spark, tmp_path, monkeypatch):
    from maskwright.operators import span_store

    written = []
    whole = span_store.stored
    monkeypatch.setattr(span_store, "stored", lambda df, name: written.append(df.columns) or whole(df, name))
    texts = ["mail a@b.com"] * 5 + [f"mail a{i}@b.com" for i in range(3000)] + [None, None, ""]
    df = spark.createDataFrame([(i % 7 or None, t) for i, t in enumerate(texts)], "id int, text string")
    store = SpanStore(spark, str(tmp_path / "spans"))
    told = store.predict(df, "text", run=1)
    rows = told.rows.collect()
    assert told.scanned == 3002 and sorted((r.id or 0, r.text or "") for r in rows) == sorted(
        (i % 7, t or "") for i, t in enumerate(texts))
    assert all(len(r.spans) == (1 if r.text else 0) for r in rows)
    assert written and all(set(columns) <= {"content", "__content", "n", "spans"} for columns in written)
    assert store.predict(df, "text", run=2).scanned == 0
