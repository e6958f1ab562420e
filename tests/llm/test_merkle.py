import hashlib
import random
import zlib

import duckdb
import pytest
from maskwright.llm import merkle
from maskwright.llm.queries import ORACLES, QUERIES
from pyspark.sql import functions as F

FANOUT = 16


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def grown(leaves, fanout):
    """The levels of a tree, by the definition."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h("".join(now[i:i + fanout])) for i in range(0, len(now), fanout)])
    return levels


def path(levels, at, fanout):
    """[(siblings before, siblings after)] from a leaf up."""
    out = []
    for level in levels[:-1]:
        begin = at - at % fanout
        out.append((level[begin:at], level[at + 1:begin + fanout]))
        at //= fanout
    return out


def brute(rows, fanout=FANOUT):
    """The contract's rows for (doc_id, source, lang, n_chars, text), by the definition."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        members = sorted(
            groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[name] = members, grown([leaf_of(r) for r in members], fanout)
    top = grown([trees[n][1][-1][0] for n in names], fanout) if names else None
    out = []
    for i, name in enumerate(names):
        members, levels = trees[name]
        for at, row in enumerate(members):
            proof = path(levels, at, fanout) + path(top, i, fanout)
            claimed = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4]:
                lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
                claimed = (*row[:4], lower)
            folded = leaf_of(claimed)
            for before, after in proof:
                folded = h("".join([*before, folded, *after]))
            siblings = "".join("".join(b + a) for b, a in proof)
            out.append((row[0], leaf_of(row), levels[-1][0], top[-1][0], h(siblings), folded,
                        folded == top[-1][0]))
    return sorted(out, key=str)


def told(listed):
    folded = merkle.as_hex(merkle.fold(F.coalesce("claimed", "leaf"), F.col("proof")))
    return sorted((tuple(r) for r in listed.select(
        "doc_id", merkle.as_hex(F.col("leaf")), merkle.as_hex(F.col("subroot")),
        merkle.as_hex(F.col("root")), F.sha2(merkle.proof_text(F.col("proof")), 256), folded,
        folded == merkle.as_hex(F.col("root")),
    ).collect()), key=str)


def listed(df, **options):
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = merkle.leaf([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), lower])
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.manifest(df, carry={"claimed": F.when(chosen, changed)}, **options)


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, tree int"


def made(rng, sizes):
    """Rows of groups of the given sizes, with nulls, empty texts and repeated rows."""
    rows, i = [], 0
    for name, size in sizes:
        for _ in range(size):
            i += 1
            rows.append((
                rng.choice([i, i, i, i, None, 3]), name, rng.choice([None, "", "de"]),
                rng.choice([None, i]), rng.choice([None, "", "Ab é", "x" * (i % 50), "SAME"]),
            ))
    rows += rows[:5]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("fanout,height,sizes", [
    (16, 3, [(None, 1), ("a", 16), ("", 17), ("é", 300), ("b", 2)]),
    # Partitions of 4 leaves: many rounds, ragged last subtrees of all widths.
    (2, 2, [("a", 1), ("b", 4), ("c", 5), ("d", 67), ("e", 133), (None, 9)]),
    (3, 1, [("a", 85), ("b", 28), ("c", 82), ("d", 3), ("e", 4)]),
    (4, 1, [(f"s{i}", i % 7 + 1) for i in range(70)]),
])
def test_manifest_equals_the_definition(spark, fanout, height, sizes):
    rows = made(random.Random(fanout), sizes)
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    assert told(listed(df, fanout=fanout, height=height)) == brute(rows, fanout)


def test_nothing_and_one(spark):
    assert listed(spark.createDataFrame([], SCHEMA)).collect() == []
    one = spark.createDataFrame([(None, None, None, None, None, None, None)], SCHEMA)
    assert told(listed(one)) == brute([(None,) * 5])


def test_rounds_exchange_at_most_fanout_roots(spark):
    """Every partition gets one root of each node of its run, whatever the last one's width."""
    states = spark.createDataFrame(
        [("t", p, 23, bytes([p]) * 32, []) for p in range(23)],
        f"tree string, part bigint, parts bigint, node binary, proof {merkle.PROOF}",
    )
    first = merkle._exchange(states, 1, 4)
    rows = {r["part"]: r for r in first.collect()}
    assert sorted(rows) == list(range(23))
    assert [len(rows[p]["proof"][0]["siblings"]) // 32 for p in (0, 3, 20, 22)] == [3, 3, 2, 2]
    second = {r["part"]: r for r in merkle._exchange(first, 4, 4).collect()}
    # Partitions 0 to 15 are one run of four subtrees; 16 to 22 one of two.
    assert len({second[p]["node"] for p in range(16)}) == 1
    assert len({second[p]["node"] for p in range(16, 23)}) == 1
    assert [len(second[p]["proof"][1]["siblings"]) // 32 for p in (0, 15, 16, 22)] == [3, 3, 1, 1]


def test_query_equals_the_definition(spark, folder):
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select(*names).collect()]
    got = QUERIES["op12_merkle_manifest"](spark, folder)
    assert got.columns == [
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_the_sql_equals_the_definition():
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, source VARCHAR, lang VARCHAR, n_chars BIGINT, text VARCHAR)")
    rows = made(random.Random(16), [(None, 1), ("a", 16), ("", 17), ("é", 300), ("b", 2)])
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    assert sorted(con.execute(ORACLES["op12_merkle_manifest"]).fetchall(), key=str) == brute(rows)
