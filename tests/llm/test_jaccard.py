import random

import numpy as np
import pytest

from maskwright.llm import jaccard
from maskwright.llm.components import components


def _shingles(text, size=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lower + " ":
        if c in " \t\n\v\f\r":
            words, word = words + [word] if word else words, ""
        else:
            word += c
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def _brute(docs, percent=90, size=3):
    """Components by comparing all pairs: (doc_id, size, smallest id) of each row."""
    sets = [_shingles(t, size) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * len(a | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc, _) in enumerate(docs):
        r = find(i)
        least[r] = min((x for x in (least.get(r), doc) if x is not None), default=None)
    return [(doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(docs)]


def _words(pick, n):
    return [pick.choice("abcdefgh") + pick.choice("xyz") + str(pick.randint(0, 40)) for _ in range(n)]


def _corpus(seed, groups=8, copies=14):
    """Groups of exact and near copies, chains of edits, passages that many share."""
    pick = random.Random(seed)
    passage, texts = " ".join(_words(pick, 40)), []
    for g in range(groups):
        base = _words(pick, pick.choice([4, 12, 60, 150]))
        texts.append(" ".join(base))
        chain = list(base)
        for c in range(copies):
            words = list(chain if g % 2 else base)
            for _ in range(pick.choice([0, 1, 1, 2, 6])):
                words[pick.randrange(len(words))] = "edit" + str(pick.randint(0, 3))
            chain = words
            texts.append(("  " if c % 3 else "\n").join(words).upper() if c % 4 == 0
                         else " ".join(words))
    texts += [passage + " " + " ".join(_words(pick, 20)) for _ in range(25)]
    texts += [" ".join(_words(pick, 50)) for _ in range(20)]
    texts += [None, "", " \t\n", "one", "ONE", "one two", "one two", "a\x0bb\x0cc", "a b c\x85d"]
    pick.shuffle(texts)
    docs = list(enumerate(texts))
    return docs + [docs[3], (None, docs[5][1]), (None, "lonely words of no id here")]


def _got(frame, docs, **options):
    rows = jaccard.join(frame(docs), **options).collect()
    return sorted(map(str, ((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows)))


@pytest.mark.parametrize("seed,block", [(1, 512), (3, 2)])
def test_components_equal_brute_force(frame, monkeypatch, seed, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    docs = _corpus(seed)
    assert _got(frame, docs) == sorted(map(str, _brute(docs)))


def test_other_shingles_and_thresholds(frame, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    docs = _corpus(6)
    got = _got(frame, docs, percent=80, size=5)
    assert got == sorted(map(str, _brute(docs, 80, 5)))


def test_one_large_group_of_near_copies(frame, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    pick = random.Random(9)
    base, texts = _words(pick, 120), []
    for _ in range(150):
        words = list(base)
        for _ in range(pick.randint(0, 3)):
            words[pick.randrange(120)] = "e" + str(pick.randint(0, 999))
        texts.append(" ".join(words))
    docs = list(enumerate(texts * 2))
    assert _got(frame, docs) == sorted(map(str, _brute(docs)))


def test_joining_by_shuffle_gives_the_same(frame, monkeypatch):
    docs = _corpus(4, groups=3)
    monkeypatch.setattr(jaccard, "fits", lambda df, rows: False)
    assert _got(frame, docs) == sorted(map(str, _brute(docs)))


def test_no_documents_and_very_long_ones(frame):
    assert jaccard.join(frame([])).collect() == []
    text = " ".join(f"w{i % 9973} v{i % 89}" for i in range(100_000))
    docs = [(1, text), (2, text + " end"), (3, text[:len(text) // 2])]
    assert _got(frame, docs) == sorted(map(str, _brute(docs)))


def test_keep_one_drops_only_copies(frame):
    docs = _corpus(5)
    kept = jaccard.keep_one(frame(docs))
    assert kept.columns == frame(docs).columns
    got = [r["doc_id"] for r in kept.collect()]
    rows = _brute(docs)
    # One row per component, that of the smallest id; rows without words stay.
    want = [doc for doc, n, least in rows if n == 0]
    want += list({least for _, n, least in rows if n})
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_overlap_bounds_hold():
    for n in range(1, 400):
        need = jaccard.overlap(n, 90)
        assert 100 * need >= 90 * n > 100 * (need - 1)
        assert need <= jaccard.sample_size(n, 90) + need - jaccard.slack(n) <= n


def test_components_of_links(spark):
    pick, n = random.Random(7), 300
    links = [(i + 1, i) for i in range(n)]  # a chain, a star and random links
    links += [(1000, 1000 + i) for i in range(1, n)] + [(5, 5)]
    links += [(2000 + pick.randrange(n), 2000 + pick.randrange(n)) for _ in range(200)]
    got = {r["node"]: r["root"] for r in components(
        spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    root = {x: x for link in links for x in link if link[0] != link[1]}
    for _ in range(n):
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_a_shared_passage_makes_few_comparisons():
    """Of 5,000 sets that share a tenth and nothing else, hardly any pair is compared in full."""
    rng = np.random.default_rng(3)
    passage = rng.integers(0, 2**63, 12).astype(np.uint64)
    rows = [
        (i, np.unique(np.concatenate([passage, rng.integers(0, 2**63, 108).astype(np.uint64)])))
        for i in range(5000)
    ]
    near = [(5000 + i, np.sort(np.concatenate([rows[i][1][2:], passage[:1] + np.uint64(i + 1)])))
            for i in range(20)]
    compared = 0
    for k in range(0, 5000, 1000):
        block = jaccard._Block(rows[k:k + 1000], 90)
        for cid, shingles in rows[::10]:
            assert [int(block.cids[i]) for i in block.similar(shingles)] == (
                [cid] if k <= cid < k + 1000 else [])
        compared += block.compared
    # 500 sets against 5,000 are 2,500,000 pairs.
    assert compared < 25_000
    block = jaccard._Block(rows[:1000], 90)
    for cid, shingles in near:
        want = [i for i in range(1000) if jaccard.similar_sets(rows[i][1], shingles, 90)]
        assert block.similar(shingles) == want == [cid - 5000]


def test_blocks_equal_brute_force():
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(40):
        base = np.unique(rng.integers(0, 2**63, rng.integers(1, 80)).astype(np.uint64))
        for _ in range(6):
            keep = base[rng.random(len(base)) > rng.choice([0, 0.03, 0.08])]
            more = rng.integers(0, 2**63, rng.integers(0, 4)).astype(np.uint64)
            one = np.unique(np.concatenate([keep, more]))
            if len(one):
                sets.append(one)
    for percent in (50, 80, 90, 100):
        block = jaccard._Block(list(enumerate(sets)), percent)
        for s in sets:
            assert block.similar(s) == [
                i for i, other in enumerate(sets) if jaccard.similar_sets(other, s, percent)]
