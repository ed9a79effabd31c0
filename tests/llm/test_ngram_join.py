"""N-gram Jaccard join against all pairs."""

import random

import numpy as np
import pytest

from prodsearch.llm import ngram_join, queries


def grams(text, n=4):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def brute(ids_texts, threshold=85):
    """{position: (n_shingles, component)} by comparing all pairs."""
    sets = [grams(t) for _, t in ids_texts]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j]:
                same = len(sets[i] & sets[j])
                if 100 * same >= threshold * (len(sets[i]) + len(sets[j]) - same):
                    parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(ids_texts):
        least[root(i)] = min(least.get(root(i), d), d)
    return [(len(sets[i]), least[root(i)]) for i in range(len(sets))]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10 ** 6)}"
    return words


def corpus(seed, n_groups=25):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    line = [rng.choice(vocab) for _ in range(9)]
    out = [None, "", " \n", "One two", "one TWO", "one two three", "a", "A"]
    for _ in range(n_groups):
        n = rng.choice([3, 5, 8, 12, 20, 60, 200])
        base = [rng.choice(vocab) for _ in range(n)]
        for _ in range(rng.choice([1, 2, 6, 15])):
            w = edited(rng, base, rng.choice([0, 0, 1, 1, 2, n // 50 + 1, n // 12]))
            if rng.random() < 0.3:
                w = line + w
            out.append(" ".join(w).replace("w1 ", "W1\t"))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(docs_of, seed):
    texts = corpus(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.cluster(docs_of(texts)).collect()}
    want = brute(list(enumerate(texts)))
    assert got == dict(enumerate(want))


def test_chains_and_blocks(docs_of):
    """Groups whose members link only through others, compared in many blocks."""
    rng = random.Random(6)
    words = [f"v{i}" for i in range(120)]
    chain = []
    for _ in range(40):
        chain.append(" ".join(words))
        words = edited(rng, words, 1)
    chain += [" ".join(edited(rng, words, rng.randint(0, 4))) for _ in range(40)]
    rng.shuffle(chain)
    want = dict(enumerate(brute(list(enumerate(chain)))))
    for blocks in ({}, {"block_nodes": 7}, {"block_grams": 1000}):
        got = {r.doc_id: (r.n_shingles, r.component_id)
               for r in ngram_join.cluster(docs_of(chain), **blocks).collect()}
        assert got == want


def test_overlaps_sum_over_fragments(monkeypatch):
    monkeypatch.setattr(ngram_join, "FRAGMENT_GRAMS", 5)
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint64)) for _ in range(12)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = ngram_join.overlaps(sets)
    for i in range(12):
        for j in range(12):
            assert i == j or got[i, j] == want[i][j]
    assert (ngram_join.overlaps(sets[:5], sets[5:]) == np.array(want)[:5, 5:]).all()


def test_a_shared_fragment_for_every_pair_that_links():
    """The guarantee behind the candidates, on random sets near the threshold."""
    rng = np.random.default_rng(8)
    classes = ngram_join.SizeClasses()
    for _ in range(3000):
        n = int(rng.integers(2, 60)) if rng.random() < 0.7 else int(rng.integers(60, 700))
        a = np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64))
        drop = int(rng.integers(0, max(1, n // 6) + 1))
        b = np.unique(np.r_[a[rng.permutation(len(a))[drop:]],
                            rng.integers(0, 2 ** 64, int(rng.integers(0, max(1, n // 6) + 1)), dtype=np.uint64)])
        same = len(np.intersect1d(a, b))
        if len(b) and 100 * same >= 85 * (len(a) + len(b) - same) and not np.array_equal(a, b):
            sketches = [np.frombuffer(ngram_join.sketch_of(x), np.uint8)[None] for x in (a, b)]
            assert not ngram_join.far_apart(*sketches, np.array([len(a)]), np.array([len(b)]), 85)[0]
            every = np.union1d(a, b)
            for share in (0, 0.1, 0.6, 1):
                common = every[rng.random(len(every)) < share]
                assert len(np.intersect1d(ngram_join.signatures(a, classes, common),
                                          ngram_join.signatures(b, classes, common)))


def test_query_against_brute_force(spark, sf):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op5_ngram_join(spark, sf).collect()}
    assert got == {d: w for (d, _), w in zip(texts, brute(texts))}


def test_repeats_nulls_and_empty(docs_of):
    t = " ".join(f"x{i}" for i in range(50))
    rows = [(5, t, None, None, None), (5, t, "de", None, None), (None, t, None, None, None), (3, t + " y", None, None, None),
            (9, None, None, None, None), (9, None, None, None, None), (None, "", None, None, None)]
    df = docs_of(rows, node="clash", comp=1)
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in ngram_join.cluster(df).collect())
    assert got == sorted([(5, 47, 3), (5, 47, 3), (-1, 47, 3), (3, 48, 3), (9, 0, 9), (9, 0, 9), (-1, 0, -1)])
    kept = ngram_join.without_near_copies(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == sorted(
        [(3, t + " y"), (9, ""), (9, ""), (-1, "")])
    assert ngram_join.cluster(df.limit(0)).count() == 0
    assert ngram_join.without_near_copies(df.limit(0)).count() == 0


def test_one_row_of_exact_repeats_stays(docs_of):
    t = " ".join(f"x{i}" for i in range(50))
    df = docs_of([(5, t, "en", "s", 1)] * 4 + [(6, "other words here now", "en", "s", 1)] * 2)
    assert sorted(r.doc_id for r in ngram_join.without_near_copies(df).collect()) == [5, 6]
