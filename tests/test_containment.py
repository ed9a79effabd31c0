"""Containment by q-gram anchors: long texts without spaces, many names,
all pattern lengths."""

import random
import time

from pyspark.sql import functions as F

from prodsearch.operators import joins


def pairs(df, a, b):
    return {(r[a], r[b]) for r in df.collect()}


def test_long_texts_without_spaces(spark):
    rng = random.Random(2)
    alphabet = "".join(chr(c) for c in range(0x4E00, 0x4E00 + 3000))
    texts = ["".join(rng.choices(alphabet, k=300_000)), "".join(rng.choices("ABCDEFGHIJKLMNOPabcdef0123456789+/", k=300_000))]
    pats = [t[at:at + n] for t in texts for at, n in ((0, 40), (299_000, 8), (150_000, 3), (77_777, 300))]
    pats += ["".join(rng.choices(alphabet, k=n)) for n in (1, 2, 5, 30) for _ in range(10)]
    t = spark.createDataFrame(list(enumerate(texts)), "tid long, text string")
    p = spark.createDataFrame(list(enumerate(pats)), "pid long, p string")
    joins.containment_join(t.limit(1), p.limit(1), "tid", "text", "pid", "p").count()
    t0 = time.perf_counter()
    got = pairs(joins.containment_join(t, p, "tid", "text", "pid", "p"), "tid", "pid")
    assert time.perf_counter() - t0 < 30
    assert got == {(i, j) for i, s in enumerate(texts) for j, q in enumerate(pats) if q in s}


def test_all_lengths_and_scripts(spark):
    rng = random.Random(3)
    alphabet = ["a", "b", "é", "한", "\U0001F600", " ", "\n", "ab"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(80)] + [None, ""]
    pats = ["".join(rng.choices(alphabet, k=k)) for k in range(1, 25) for _ in range(6)]
    pats = [q for q in pats if q.strip(" \n")]
    t = spark.createDataFrame(list(enumerate(texts)), "tid long, text string")
    p = spark.createDataFrame(list(enumerate(pats)), "pid long, p string")
    got = pairs(joins.containment_join(t, p, "tid", "text", "pid", "p"), "tid", "pid")
    assert got == {(i, j) for i, s in enumerate(texts) if s is not None for j, q in enumerate(pats) if q in s}


def test_names_beyond_the_direct_bound(spark, monkeypatch):
    """Keys with many names go through the anchors, others are tested directly."""
    rng = random.Random(4)
    monkeypatch.setattr(joins, "DIRECT_NAMES", 5)
    names = [(q, "".join(rng.choices("abc ", k=rng.randint(1, 5)))) for q in range(6) for _ in range(3 * q + 1)]
    names += [(5, None), (4, ""), (9, None)]
    answers = [(q, a, "".join(rng.choices("abc ", k=rng.randint(0, 12)))) for q in range(10) for a in range(8)]
    answers.append((5, 99, None))
    got = {(r.q, r.a): r.grounded for r in joins.grounding(
        spark.createDataFrame(answers, "q long, a long, text string"),
        spark.createDataFrame(names, "q long, name string"), "q", "a", "text", "name").collect()}
    want = {}
    for q, a, t in answers:
        own = [n for k, n in names if k == q]
        want[q, a] = int(any(n is not None and t is not None and n in t for n in own)) if own else None
    assert got == want


def test_large_taxonomy_equals_the_small_path(spark, monkeypatch):
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, "".join(rng.choices("abcdE ", k=40))) for i in range(60)] + [(99, None)],
                                 "doc_id long, text string")
    tax = spark.createDataFrame([(f"l{i % 7}", i % 7, "".join(rng.choices("abcDe", k=rng.randint(1, 4))))
                                 for i in range(60)] + [("l0", 0, " ")], "label string, ord int, kw string")
    small = {r.doc_id: r.label for r in joins.classify_by_table(docs, "doc_id", "text", tax).collect()}
    monkeypatch.setattr(joins, "SMALL_TAXONOMY", 3)
    large = joins.classify_by_table(docs, "doc_id", "text", tax)
    assert small == {r.doc_id: r.label for r in large.collect()}
    assert len(set(small.values())) > 2


def test_anchor_is_the_rarest_window(spark):
    """A pattern of common windows and one rare one meets only the texts with the rare one."""
    texts = [(i, "aaaa bbbb cccc dddd") for i in range(50)] + [(50, "aaaa bbbb xyzw dddd")]
    t = spark.createDataFrame(texts, "tid long, text string")
    p = spark.createDataFrame([(1, "bbbb xyzw dddd"), (2, "aaaa bbbb zzzz dddd")], "pid long, p string")
    out = joins.containment_join(t, p, "tid", "text", "pid", "p")
    assert pairs(out, "tid", "pid") == {(50, 1)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" not in plan and "PythonUDF" not in plan
    assert out.where(F.col("tid").isNull()).count() == 0
