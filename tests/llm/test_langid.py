import unicodedata
import zlib

import numpy as np
from pyspark.sql import functions as F

from maskwright.llm import langid

SCHEMA = "doc_id bigint, text string, lang string, score string, lang_pred string"
WORDS = {
    "en": "the and of to in that with which have from they this were been would there their",
    "de": "der die und das nicht sich auch werden nach über schon zwischen größe für können",
    "fr": "le les des une dans qui était être été avec pour plus même après où très ça",
    "el": "και το της την από στο είναι για που δεν θα με σε ένα αυτό",
}


def _docs(n=240):
    random, rows = np.random.default_rng(4), []
    for i in range(n):
        lang = list(WORDS)[i % 4]
        rows.append((i, " ".join(random.choice(WORDS[lang].split(), 30)), lang))
    return rows


def test_held_out_languages_are_found(frame):
    docs = frame(_docs(), SCHEMA)
    done = langid.predict(docs, langid.train_on_folds(docs)).withColumn(
        "held_out", langid.in_fold("doc_id")).collect()
    held = [r for r in done if r["held_out"]]
    assert {r["doc_id"] for r in held} == {
        i for i in range(240) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert all(r["lang_pred"] == r["lang"] and 0 < r["score"] <= 1 for r in held)


def test_labels_of_held_out_rows_and_own_labels_do_not_matter(frame):
    rows = _docs()
    lied = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    keys = ("doc_id", "lang_pred", "score")
    got = []
    for some in (rows, lied):
        docs = frame(some, SCHEMA)
        done = langid.predict(docs.select("doc_id", "text"), langid.train_on_folds(docs))
        got.append(sorted(tuple(r[k] for k in keys) for r in done.collect()))
    assert got[0] == got[1]


def test_texts_without_letters_and_odd_rows(frame):
    odd = [(900, None, "en"), (901, "", "en"), (902, "123 -- ́ 🙂", "en"), (None, "the and of", None),
           (903, "the " * 200_000, None), (904, "a", None), (900, None, "en")]
    docs = frame(_docs() + odd, SCHEMA)
    done = langid.predict(docs, langid.train_on_folds(docs)).collect()
    assert len(done) == 247
    by_id = {r["doc_id"]: r for r in done}
    for i in (900, 901, 902):
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    assert by_id[903]["lang_pred"] == "en" and by_id[None]["lang_pred"] == "en"
    assert by_id[904]["lang_pred"] in WORDS


def test_nothing_to_learn_or_predict(frame):
    docs = frame([(1, "words", None)], SCHEMA)
    row = langid.predict(docs, langid.train_on_folds(docs)).first()
    assert (row["lang_pred"], row["score"]) == ("und", 0.0)
    empty = frame([], SCHEMA)
    assert langid.predict(empty, langid.train(empty)).collect() == []


def test_profiles_follow_the_definition():
    profiles = langid.Profiles(64, 3, 1)
    letter = profiles._letter
    line = [0, ord("a"), ord("b"), 0]
    want = sum(
        letter(line[i]).astype(int) * np.roll(letter(line[i + 1]), 1) * np.roll(letter(line[i + 2]), 2)
        for i in range(2)
    )
    assert (next(profiles.profiles(["Ab!"])) == want).all()


def test_slow_path_gives_the_same(monkeypatch):
    texts = ["the and of", "größe über", "日本語 text", None, "1"]
    fast = list(langid.Profiles(64, 3, 1).profiles(texts))
    monkeypatch.setattr(langid, "LETTERS", 4)
    slow = list(langid.Profiles(64, 3, 1).profiles(texts))
    for a, b in zip(fast, slow, strict=True):
        assert (a is None) == (b is None) and (a is None or (a == b).all())


def test_prototypes_are_sums_over_all_rows(frame):
    docs = frame(_docs(40), SCHEMA)
    got = np.zeros(langid.DIMENSIONS)
    for r in langid.train(docs).filter(F.col("lang") == "en").collect():
        got[r["position"]] = r["value"]
    profiles = langid.Profiles(langid.DIMENSIONS, langid.GRAM, langid.SEED)
    want = sum(profiles.profiles([t for _, t, lang in _docs(40) if lang == "en"]))
    assert (got == want).all()


def test_predictions_equal_the_definition(frame):
    """Prototypes, cosines and languages against a plain sum over all n-grams."""
    docs = _docs(60) + [(900, "Ελ\u0301 mixed und 東京 text" * 3, None), (901, "ab", None)]
    profiles = langid.Profiles(langid.DIMENSIONS, langid.GRAM, langid.SEED)

    def profile(text):
        words = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in text.lower()).split()
        points = [0, *[p for w in words for p in [*map(ord, w), 0]]]
        total = np.zeros(langid.DIMENSIONS, dtype=np.int64)
        for i in range(len(points) - langid.GRAM + 1):
            total += profiles._gram_vector(points[i:i + langid.GRAM])
        return total

    sums = {}
    for i, text, lang in docs:
        if lang is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            sums[lang] = sums.get(lang, 0) + profile(text)
    table = frame(docs, SCHEMA)
    done = langid.predict(table, langid.train_on_folds(table)).collect()
    assert len(done) == len(docs)
    for r in done:
        own = profile(r["text"])
        cosines = {k: float(v @ own / np.linalg.norm(v) / np.linalg.norm(own)) for k, v in sums.items()}
        best = max(sorted(cosines), key=cosines.get)
        assert r["lang_pred"] == best and abs(r["score"] - max(0, cosines[best])) < 1e-5
