"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from prodsearch.llm import periodic_runs as R
from prodsearch.llm import queries


def brute_runs(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        same = [w[i] == w[i + q] for i in range(n - q)]
        i = 0
        while i < len(same):
            if not same[i]:
                i += 1
                continue
            j = i
            while j < len(same) and same[j]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                s = w[i:i + length]
                if not any(all(s[k] == s[k + d] for k in range(length - d)) for d in range(1, q)):
                    out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return [x for i, x in enumerate(w) if i not in gone]


def odd_words(rng):
    kind = rng.randrange(5)
    if kind == 0:
        return [rng.choice("ab") for _ in range(rng.randint(0, 60))]
    if kind == 1:
        root = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
        return [rng.choice("abc") for _ in range(rng.randint(0, 5))] + (root * rng.randint(1, 12))[:rng.randint(1, 90)]
    if kind == 2:
        return [x for i in range(rng.randint(1, 60)) for x in (rng.choice("abcdefgh"), "|")]
    if kind == 3:
        return [c for c in "abcd" for _ in range(rng.randint(1, 14))] * rng.randint(1, 6)
    return [str(rng.randrange(50)) for _ in range(rng.randint(0, 200))]


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        texts = [odd_words(rng) for _ in range(rng.randint(1, 12))]
        got = R.text_runs([[x.encode() for x in w] for w in texts])
        for w, runs in zip(texts, got):
            assert runs == brute_runs(w), w


def test_grammar_extensions():
    rng = random.Random(6)
    for _ in range(40):
        a = np.array([rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randint(2, 120))], np.int64)
        a[rng.randrange(len(a))] = -1
        g, n = R.Grammar(a), len(a)
        for _ in range(200):
            i, j = sorted(rng.sample(range(n), 2))
            right = next((k for k in range(n - j) if a[i + k] != a[j + k]), n - j)
            left = next((k for k in range(i) if a[i - 1 - k] != a[j - 1 - k]), i)
            assert (g.right(i, j), g.left(i, j)) == (right, left)


def test_every_word_the_same():
    assert R.text_runs([[b"a"] * 30_000]) == [[(0, 30_000, 1)]]


def planted(doc_id, w):
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def check(row, doc_id, text):
    w = planted(doc_id, text.encode().split() if text else [])
    runs = brute_runs(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    assert row.n_runs == len(runs)
    assert (row.start, row.length, row.period) == best
    assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
    kept = b" ".join(brute_collapsed(w, runs))
    assert row.collapsed_sha256 == hashlib.sha256(kept).hexdigest()
    return len(runs)


def test_query(docs_of):
    rng = random.Random(7)
    texts = [None, "", " \n\t ", "a\x0bb\x85c", "x " * 500, "é ü\n" * 40]
    texts += [" ".join(odd_words(rng)) for _ in range(150)]
    df = docs_of(texts + [texts[-1]], runs="clash", collapsed=1)
    rows = queries.runs_digest(R.periodic_runs(R.with_planted_runs(df))).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts) + 1))
    assert sum(check(r, r.doc_id, (texts + [texts[-1]])[r.doc_id]) for r in rows) > 50
    assert queries.runs_digest(R.periodic_runs(R.with_planted_runs(df.limit(0)))).count() == 0


def test_query_on_driver_table(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op12_periodic_runs(spark, sf).collect()
    assert len(rows) == len(texts)
    short = [r for r in rows if len(texts[r.doc_id] or "") < 4000]
    assert sum(check(r, r.doc_id, texts[r.doc_id]) for r in short) > 5


def test_repeated_and_null_ids(docs_of):
    rows = [(None, "a " * 9, None, None, None)] * 3 + [(5, "b c " * 9, None, None, None)] * 2
    got = R.periodic_runs(docs_of(rows)).collect()
    assert sorted((r.doc_id or 0, r.runs[0].length, r.collapsed) for r in got) == [
        (0, 9, "a")] * 3 + [(5, 18, "b c")] * 2


def test_memory_bound_batches(docs_of, monkeypatch):
    monkeypatch.setattr(R, "BATCH_WORDS", 7)
    got = R.periodic_runs(docs_of(["z " * k for k in range(20)])).agg(F.sum(F.size("runs"))).first()[0]
    assert got == 14


@pytest.mark.parametrize("q,want", [(1, []), (12, [2, 3]), (97, [97]), (98, [2, 7])])
def test_prime_divisors(q, want):
    assert R.prime_divisors(q) == want
