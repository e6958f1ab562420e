"""Results must not depend on how later passes split the files of the input."""

import random
from itertools import count

import pytest
from pyspark.sql import functions as F

from maskwright.llm import ball_tree, hash_forest, jaccard, secret_scan, vectors, warc_zip
from maskwright.llm.common import stored


@pytest.fixture
def splits(spark, monkeypatch):
    """Every result that is stored changes the cores, as lost or new executors would."""
    turn, name = count(), "spark.sql.files.minPartitionNum"

    def changing(df, label):
        done = stored(df, label)
        spark.conf.set(name, str([1, 8][next(turn) % 2]))
        return done

    for module in (ball_tree, hash_forest, jaccard, secret_scan, vectors, warc_zip):
        if hasattr(module, "stored"):
            monkeypatch.setattr(module, "stored", changing)
    spark.conf.set(name, "8")
    yield
    spark.conf.unset(name)


@pytest.fixture
def on_disk(spark, tmp_path):
    """A frame as a table of 8 files."""

    def make(rows, schema):
        df = spark.createDataFrame(rows, schema)
        df.repartition(8).write.parquet(f"{tmp_path}/table")
        return spark.read.schema(df.schema).parquet(f"{tmp_path}/table")

    return make


def _text(seed):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randint(0, 999)}" for _ in range(60))


def test_near_copies(on_disk, splits):
    docs = [(i, _text(i // 2) + (" end" if i % 2 else "")) for i in range(80)]
    table = on_disk(docs, "doc_id bigint, text string")
    want = {(i, i - i % 2) for i, _ in docs}
    got = jaccard.join(table).select("doc_id", "component_id").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(docs)
    assert sorted(r["doc_id"] for r in jaccard.keep_one(table).collect()) == list(range(0, 80, 2))


def test_secrets(on_disk, splits):
    keys = [f"q7Xz{i:03}m2Vb4Nc8Rt{i}" for i in range(40)]
    docs = [(i, "x" * i + f" password={k}", "a") for i, k in enumerate(keys)]
    table = on_disk(docs, "doc_id bigint, text string, source string")
    for r in secret_scan.scan(table).collect():
        assert {s["start"] for s in r["spans"]} == {r["doc_id"] + 1, r["doc_id"] + 10}
    masked = secret_scan.mask(table, length_col=None).collect()
    assert sorted((r["doc_id"], r["text"]) for r in masked) == [
        (i, "x" * i + " [SECRET]") for i in range(40)]


def test_packages(on_disk, splits):
    pages = [(i, "u", f"page {i // 2}") for i in range(80)]
    table = on_disk(pages, "page_id bigint, url string, html string")
    got = warc_zip.read_archives(warc_zip.write_archives(table)).collect()
    assert sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in got) == [
        (i, "revisit", i - 1) if i % 2 else (i, "response", None) for i in range(80)]


@pytest.mark.parametrize("search", [ball_tree.search, hash_forest.search])
def test_vectors(on_disk, splits, search):
    pick = random.Random(1)
    table = on_disk([(i, [pick.gauss(0, 1) for _ in range(8)]) for i in range(200)],
                    "vec_id bigint, embedding array<float>")
    got = search(table, k=199, every=1, shard_rows=60)
    pairs = got.filter(F.col("query_id") != F.col("vec_id")).select("query_id", "vec_id")
    assert got.filter(F.col("query_id") == F.col("vec_id")).count() == 0
    assert pairs.count() == pairs.distinct().count()
