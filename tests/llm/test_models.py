"""Language model and language identification: exact counts, held-out gains."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from prodsearch.llm import brown_lm, langid, queries


def words(text):
    return (text or "").encode().lower().split()


def brute_base(rows):
    train = Counter()
    for d, t in rows:
        if zlib.crc32(("" if d is None else str(d)).encode()) % 5 != 1:
            train.update(words(t))
            train[None] += 1
    n, v = sum(train.values()), len(train)
    out = []
    for d, t in rows:
        w = [*words(t), None]
        out.append((zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1, len(w),
                    sum(train[x] > 0 for x in w), n,
                    sum(math.log10((train[x] + .5) / (n + .5 * (v + 1))) for x in w)))
    return out


@pytest.mark.parametrize("sizes", [brown_lm.Sizes(), brown_lm.Sizes(40, 16, 8, 50)])
def test_base_counts(spark, sf, sizes):
    """Also with a small broadcast table, so that most words are joined."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: r for r in brown_lm.train_and_score(
        spark.read.parquet(f"{sf}/documents.parquet"), sizes=sizes).collect()}
    for (d, _), (held, n, k, total, base) in zip(rows, brute_base(rows)):
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, k, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)


def test_model_is_a_distribution_and_beats_the_base(spark, sf):
    got = queries.op6_lm_scoring(spark, sf).where("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_class_probabilities_sum_to_one(docs_of):
    df = docs_of(["a b a c. d e", "b b a", "d c. a e e e", None])
    m, counts = brown_lm.train(df)
    assert np.allclose((10 ** m.transition).sum(axis=1), 1)
    # words seen, plus one for all unseen, per class
    per = {}
    rows = {r.wh: r for r in counts.collect()}
    head = brown_lm.Lookup(m.head_keys)
    for wh, r in rows.items():
        u = brown_lm.units_of(head, np.array([wh], np.int64).view(np.uint64), np.array([r.ending]), m.sizes)[0]
        c = m.cls[u]
        per[c] = per.get(c, 0) + (r.n + 0.5) / 10 ** m.emission_log[c]
    for c, total in per.items():
        assert total + 0.5 / 10 ** m.emission_log[c] == pytest.approx(1)


def test_exchange_finds_planted_classes():
    rng = random.Random(3)
    b = np.zeros((31, 31))
    for _ in range(4000):       # three groups of ten follow one another; unit 0 is the end
        x = rng.randrange(3)
        b[1 + 10 * x + rng.randrange(10), 1 + 10 * ((x + 1) % 3) + rng.randrange(10)] += 1
    cls = brown_lm.exchange(b, classes=4, rounds=10)
    groups = [set(cls[1 + 10 * k:11 + 10 * k]) for k in range(3)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 3


def test_lm_edges(docs_of):
    df = docs_of([(1, "a b", None, None, None), (1, "a b", None, None, None), (None, None, None, None, None),
                  (2, "", None, None, None)], score=1, n="x")
    got = brown_lm.train_and_score(df).collect()
    assert len(got) == 4 and sorted(r.n_tokens for r in got) == [1, 1, 3, 3]
    assert brown_lm.train_and_score(df.limit(0)).count() == 0


def test_language_held_out_accuracy(spark, sf):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op7_language_id(spark, sf).collect()
    assert len(got) == len(lang)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_more_labels_than_are_learned(docs_of, monkeypatch):
    """Noisy labels beyond the bound: the frequent ones are learned."""
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    words = {"aa": "bla blub", "bb": "kix kox", "cc": "zum zam"}
    rows = [(i, f"{words[v]} {words[v]}", v, None, None) for i, v in enumerate(list(words) * 20)]
    rows += [(100 + i, "bla blub", f"typo{i}", None, None) for i in range(12)]
    got = langid.identify(docs_of(rows)).collect()
    assert len(got) == len(rows) and {r.lang_pred for r in got} == set(words)
    assert all(r.lang_pred == "aa" for r in got if r.doc_id >= 100)


def test_language_edges(docs_of):
    texts = ["the quick brown fox", "der schnelle braune Fuchs", None, "", "123 !?", "汉字", "the dog"] * 3
    rows = [(i, t, None if i == 6 else "de" if t and "der" in t else "en", None, None) for i, t in enumerate(texts)]
    df = docs_of(rows, score="clash", held_out=1)
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    for i, t in enumerate(texts):
        if t in (None, "", "123 !?"):
            assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
        else:
            assert got[i].lang_pred in ("en", "de")
    assert langid.identify(df.limit(0)).count() == 0
    none = langid.identify(docs_of([(1, "text", None, None, None)])).collect()
    assert [r.lang_pred for r in none] == ["und"]


def test_subwords_against_plain_loops():
    for t in ["Ab c", "été, ß1x", "汉 a"]:
        s = " " + " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split()) + " "
        n = sum(" " not in s[i + 1:i + k - 1] and not (k == 1 and s[i] == " ")
                for k in (1, 2, 3, 4) for i in range(len(s) - k + 1))
        assert langid.subword_counts(t).sum() == n
