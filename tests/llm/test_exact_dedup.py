import hashlib
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
from maskwright.llm import exact_dedup
from maskwright.llm.queries import ORACLES, QUERIES

from compare import connect


def brute(rows):
    """{(place, doc_id): ...} by the definition, over (doc_id, text) in their order."""
    groups = defaultdict(list)
    for place, (doc_id, text, *_) in enumerate(rows):
        plain = re.sub("[\x20\x09-\x0d]+", " ", text or "")
        groups[plain].append((doc_id is None, doc_id or 0, place, doc_id))
    out = []
    for plain, members in groups.items():
        first = min(members)
        for member in members:
            out.append((member[3], first[3], len(members), member == first,
                        hashlib.sha256(plain.encode()).hexdigest()))
    return Counter(out)


def told(df):
    return Counter(
        (r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()
    )


def test_groups_equal_the_definition(frame):
    rng = random.Random(5)
    texts = [None, "", " ", "a b", "a\t\n b", "a  b ", " a b", "x" * 300_000, "A b", "a\x0bb"]
    rows = [(i, rng.choice(texts)) for i in range(60)]
    rows += [(None, "a b"), (None, "only"), (None, "only"), (7, "again"), (7, "again"), (3, None)]
    rng.shuffle(rows)
    df = frame(rows).coalesce(1)
    for heavy in (2, 4, exact_dedup.HEAVY):
        assert told(exact_dedup.groups(df, heavy=heavy)) == brute(rows)


def test_nothing(frame):
    assert exact_dedup.groups(frame([])).collect() == []
    assert exact_dedup.deduplicate(frame([])).collect() == []


def test_kept_rows_have_all_columns(spark):
    rows = [(4, "a  b", "r", "d"), (2, "a b", None, "e"), (9, None, "s", None), (1, "c", "", "")]
    df = spark.createDataFrame(rows, "doc_id int, text string, digest string, `a.row` string")
    for heavy in (2, exact_dedup.HEAVY):
        kept = exact_dedup.deduplicate(df, heavy=heavy)
        assert kept.schema == df.schema
        assert sorted(map(tuple, kept.collect())) == sorted(rows[1:])


def test_summaries_name_every_frequent_digest():
    rng = random.Random(3)
    counters = 20
    for _ in range(50):
        common = [bytes([i]) for i in range(5)]
        rows = [rng.choice(common) if rng.random() < 0.5 else rng.randbytes(4)
                for _ in range(2000)]
        batches = [pa.RecordBatch.from_arrays([pa.array(rows[i:i + 100], pa.binary())], ["digest"])
                   for i in range(0, 2000, 100)]
        seen = {}
        for batch in exact_dedup.summary(iter(batches), counters):
            seen |= dict(zip(*(c.to_pylist() for c in batch.columns), strict=True))
        assert len(seen) <= counters
        for digest, n in Counter(rows).items():
            assert seen.get(digest, 0) <= n
            assert n - seen.get(digest, 0) <= 2 * len(rows) / counters


def test_a_frequent_text_is_not_shuffled(spark):
    """A text of a third of all rows is a winner; the named digests stay within their bound."""
    df = spark.range(30_000).selectExpr(
        "id AS doc_id", "if(id % 3 = 0, 'copy', cast(id AS string)) AS text"
    ).repartition(8)
    rows = df.select(*exact_dedup._numbered(df, "doc_id", "text")).persist()
    heavy = 50
    named = exact_dedup.frequent(rows, 30_000, heavy).count()
    assert 1 <= named < 2 * heavy
    found = exact_dedup.winners(rows, heavy).collect()
    assert [(r["size"], r["first"]["doc_id"]) for r in found] == [(10_000, 0)]
    rows.unpersist()
    done = exact_dedup.groups(df, heavy=heavy)
    assert done.filter("kept").count() == 20_001
    assert done.filter("group_size = 10000 AND keep_id = 0").count() == 10_000


def test_query_equals_its_sql(spark, folder):
    got = QUERIES["op13_exact_dedup"](spark, folder)
    sql = connect(folder).execute(ORACLES["op13_exact_dedup"])
    names = [d[0] for d in sql.description]
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == sorted(sql.fetchall())
