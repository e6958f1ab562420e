import math
import random

import numpy as np
import pytest
from maskwright.llm import anchor_tree
from maskwright.llm.anchor_tree import Shard, Tree
from maskwright.llm.queries import ORACLES, QUERIES

from compare import connect

SCHEMA = "vec_id bigint, embedding array<double>, label string, row bigint, tree string"


def brute(rows, every=50, p=5, n=3, scale=256):
    """The contract's rows by the definition, over (vec_id, vector, label)."""
    good = []
    for place, (vec_id, vector, label) in enumerate(rows):
        if vec_id is None or vector is None or label is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        good.append((place, vec_id, label, [math.floor(scale * x) for x in vector]))
    out = []
    for place, anchor, label, vector in good:
        if anchor % every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(vector, v)), i, q, other)
            for q, i, other, v in good if q != place and len(v) == len(vector))
        for score, positive, _, _ in [s for s in scored if s[3] == label][:p]:
            inside = [s for s in scored if s[3] != label and 50 * -score <= 100 * -s[0] <= 95 * -score]
            out += [(anchor, positive, rank, s[1], -score, -s[0])
                    for rank, s in enumerate(inside[:n], 1)]
    return sorted(out)


def told(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("shard_rows,block", [(10_000, 256), (16, 4), (40, 1)])
def test_equals_the_definition(spark, shard_rows, block):
    rng = random.Random(block)
    rows = []
    for i in range(160):
        dim = rng.choice([3, 3, 3, 2, 0])
        centre = rng.choice([0.0, 0.5, 1.0])
        rows.append((i, [centre + rng.choice([-0.1, 0, 0.1, 0.25]) for _ in range(dim)], rng.choice("abc")))
    rows += [
        (200, None, "a"), (205, [1.0, None, 2.0], "a"), (210, [1.0, math.nan, 2.0], "b"),
        (215, [math.inf, 0.0, 1.0], "a"), (220, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], "a"),
        (10, [0.5, 0.5, 0.5], "a"), (10, [0.5, 0.5, 0.5], "a"), (250, [9.0] * 5, "lonely"),
    ]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 5, "clash") for r in rows], SCHEMA)
    got = anchor_tree.mine(df, every=5, shard_rows=shard_rows, block=block)
    want = brute(rows, every=5)
    assert len(want) > 100
    assert told(got) == want


def test_nothing(spark):
    assert anchor_tree.mine(spark.createDataFrame([], SCHEMA)).collect() == []


def clustered(rng, n, spread):
    centres = rng.normal(size=(8, 16)) * 200
    which = rng.integers(0, 8, n)
    return np.floor(centres[which] + rng.normal(size=(n, 16)) * spread).astype(np.int64)


def tree_of(vectors, labels):
    points = vectors.astype(float)
    order, parents = anchor_tree.spanning_tree(points)
    edges = [0.0 if p < 0 else float(np.linalg.norm(points[o] - points[order[p]])) + 1e-9
             for o, p in zip(order, parents)]
    return Tree([-1 - o for o in order], order, [labels[o] for o in order], vectors[order], parents,
                edges, {})


def test_bounds_hold_and_leave_most_candidates_unscored():
    """On clustered rows few candidates are scored again, and the best are found."""
    rng = np.random.default_rng(8)
    vectors = clustered(rng, 3000, 3)
    labels = rng.choice(list("abcde"), 3000).astype(object)
    shard = Shard(np.arange(3000), np.arange(3000), labels, vectors)
    anchors = clustered(np.random.default_rng(8), 200, 3)
    tree = tree_of(anchors, rng.choice(list("abcde"), 200).astype(object))
    found, walk = anchor_tree.positives(shard, tree, 5)
    assert walk.scored < 0.2 * 3000 * 200
    by_anchor = {}
    for row, *hit in found:
        by_anchor.setdefault(row, []).append(tuple(hit))
    for i, row in enumerate(tree.rows):
        scores = vectors @ tree.vectors[i]
        same = [(-int(scores[c]), c) for c in np.flatnonzero(labels == tree.labels[i])]
        assert sorted(by_anchor[row], key=lambda h: (-h[2], h[1])) == [
            (c, c, -s) for s, c in sorted(same)[:5]]
    windows = tree._replace(positives={
        row: [{"row": h[0], "vec_id": h[1], "score": h[2]} for h in hits]
        for row, hits in by_anchor.items()})
    second, walk = anchor_tree.negatives(shard, windows, 3, 50, 95)
    assert walk.scored < 0.5 * 3000 * 200
    got = {}
    for row, _, positive, _, _, *hit in second:
        got.setdefault((row, positive), []).append(tuple(hit))
    for i, row in enumerate(tree.rows):
        scores = vectors @ tree.vectors[i]
        for positive, _, score in by_anchor[row]:
            inside = sorted(
                (-int(scores[c]), c) for c in np.flatnonzero(labels != tree.labels[i])
                if 50 * score <= 100 * scores[c] <= 95 * score)[:3]
            assert sorted(got.get((row, positive), []), key=lambda h: (-h[2], h[1])) == [
                (c, c, -s) for s, c in inside]


def test_spanning_tree_is_minimal():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(60, 4))
    order, parents = anchor_tree.spanning_tree(points)
    assert sorted(order) == list(range(60)) and parents[0] == -1
    assert all(p < i for i, p in enumerate(parents))
    total = sum(np.linalg.norm(points[order[i]] - points[order[p]])
                for i, p in enumerate(parents) if p >= 0)
    edges = sorted((np.linalg.norm(points[a] - points[b]), a, b) for a in range(60) for b in range(a))
    root = list(range(60))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    least = 0.0
    for far, a, b in edges:
        if find(a) != find(b):
            root[find(a)] = find(b)
            least += far
    assert abs(total - least) < 1e-9


def test_equal_points_and_one_point():
    assert anchor_tree.spanning_tree(np.zeros((1, 3))) == ([0], [-1])
    order, parents = anchor_tree.spanning_tree(np.zeros((5, 3)))
    assert sorted(order) == [0, 1, 2, 3, 4] and parents[0] == -1


def test_query_equals_its_sql(spark, folder):
    got = QUERIES["op11_anchor_tree"](spark, folder)
    sql = connect(folder).execute(ORACLES["op11_anchor_tree"])
    names = [d[0] for d in sql.description]
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == sorted(sql.fetchall())
