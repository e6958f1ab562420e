import numpy as np
import pytest

from maskwright.llm import ball_tree, hash_forest


def _vectors(spark, rows):
    return spark.createDataFrame(
        rows, "vec_id bigint, embedding array<float>, label int, vector string, row bigint"
    )


def _rows(n=700, dim=8, seed=0, copies=120):
    random = np.random.default_rng(seed)
    rows = [(i, random.standard_normal(dim).tolist(), 1, None, None) for i in range(n)]
    # A third of equal vectors, repeated ids, odd rows, and vectors of another length.
    rows += [(n + i, [0.5] * dim, 1, None, None) for i in range(copies)]
    rows += [(40, rows[40][1], 1, None, None), (None, [1.0] * dim, 0, None, None)]
    rows += [(1000, None, 0, None, None), (1100, [1.0, None], 0, None, None),
             (1200, [float("nan")] * dim, 0, None, None), (1300, [float("inf")] * dim, 0, None, None)]
    rows += [(2000 + i, [0.1 * i, 1.0], 0, None, None) for i in range(5)]
    rows += [(3000, [0.0] * dim, 0, None, None)]
    return rows


def _kept(rows, zero=True):
    return [
        (k, i, np.float32(v).astype(float)) for k, (i, v, *_) in enumerate(rows)
        if i is not None and v is not None and None not in v and np.isfinite(v).all()
        and (zero or any(v))
    ]


def _brute(rows, every, k, score, best_first, zero=True):
    kept, out = _kept(rows, zero), []
    for a, query, q in kept:
        if query % every:
            continue
        found = sorted(
            (best_first(score(q, x)), i, score(q, x)) for b, i, x in kept
            if a != b and len(x) == len(q)
        )[:k]
        out += [(query, rank + 1, i, s) for rank, (_, i, s) in enumerate(found)]
    return out


def _product(q, x):
    return int(np.floor(64 * q) @ np.floor(64 * x))


@pytest.mark.parametrize("shard_rows", [10_000, 150])
def test_top_k_equals_brute_force(spark, shard_rows):
    rows = _rows()
    got = ball_tree.search(_vectors(spark, rows), k=20, every=20, shard_rows=shard_rows).collect()
    want = _brute(rows, 20, 20, _product, lambda s: -s)
    assert sorted(map(tuple, got)) == sorted(want)


def test_products_beyond_doubles_are_exact(spark):
    big = [3.0e7, 1.0, -2.0e7, 5.0]
    rows = [(i, [b + 4 * i for b in big], 0, None, None) for i in range(40)]
    got = ball_tree.search(_vectors(spark, rows), k=3, every=20).collect()
    exact = {i: [int(np.floor(64 * float(np.float32(x)))) for x in v] for i, v, *_ in rows}
    for r in got:
        assert r["score"] == sum(
            a * b for a, b in zip(exact[r["query_id"]], exact[r["vec_id"]], strict=True))


def test_branches_are_cut():
    random = np.random.default_rng(2)
    points = np.concatenate([random.normal(c, 0.1, (500, 4)) for c in (0, 5, -5, 20)])
    points = np.floor(64 * points).astype(np.int64)
    n = len(points)
    rows = ball_tree.Rows(np.arange(n), np.arange(n), np.full(n, np.nan), points)
    tree = ball_tree.BallTree(rows, leaf=32)
    queries = ball_tree.Rows(np.array([-1]), np.array([-1]), np.array([np.nan]), points[-1:])
    state, visited = ball_tree._Search(tree, queries, 5), []
    leaf = state._leaf
    state._leaf = lambda node, active: (visited.append(node), leaf(node, active))
    state.visit(tree.root, np.array([0]))
    assert len(visited) <= 16  # of 64 leaves
    assert state.scores[0].tolist() == sorted((points @ points[-1]).tolist(), reverse=True)[:5]


def test_empty_tables(spark):
    assert ball_tree.search(_vectors(spark, [])).collect() == []
    assert hash_forest.search(_vectors(spark, [])).collect() == []
    lone = _vectors(spark, [(0, [1.0, 2.0], 0, None, None)])
    assert ball_tree.search(lone).collect() == [] and hash_forest.search(lone).collect() == []


def _distance(q, x):
    return float(np.sqrt(((q - x) ** 2).sum()))


@pytest.mark.parametrize("shard_rows", [10_000, 150])
def test_forest_finds_equal_vectors_and_reports_exact_distances(spark, shard_rows):
    rows = _rows()
    got = hash_forest.search(_vectors(spark, rows), k=10, every=10, shard_rows=shard_rows).collect()
    want = _brute(rows, 10, 10, _distance, lambda s: s, zero=False)
    near = {}
    for query, _, i, _ in want:
        near.setdefault(query, []).append(i)
    vectors = {i: v for _, i, v in _kept(rows)}
    found = hits = 0
    for r in got:
        gap = _distance(vectors[r["query_id"]], vectors[r["vec_id"]])
        assert abs(gap - r["score"]) < 1e-12
        hits += r["vec_id"] in near[r["query_id"]]
        found += 1
        assert r["query_id"] != 3000 and r["vec_id"] != 3000  # zero vectors take no part
    assert hits / len(want) >= 0.9 and found == len(want)
    equal = {r["rank"]: r["vec_id"] for r in got if r["query_id"] == 710}
    assert [equal[i] for i in range(1, 11)] == list(range(700, 710))


def test_recall_on_the_table(spark):
    folder = "/root/testdata/sf0.1"
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = vectors.collect()
    points = np.array([r["embedding"] for r in rows], dtype=np.float32).astype(float)
    ids = np.array([r["vec_id"] for r in rows])
    near = {}
    for q in np.flatnonzero(ids % 100 == 0):
        gaps = np.sqrt(((points - points[q]) ** 2).sum(axis=1))
        gaps[q] = np.inf
        near[ids[q]] = set(ids[np.lexsort((ids, gaps))[:10]].tolist())
    got = hash_forest.search(vectors, shard_rows=500).collect()
    hits = sum(r["vec_id"] in near[r["query_id"]] for r in got)
    assert hits / (10 * len(near)) >= 0.9
