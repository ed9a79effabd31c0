"""Vector top-k, category fallback, ranking, embeddings."""

import numpy as np
from pyspark.sql import functions as F

from prodsearch.operators import retrieve


def brute(P, Q, k, exclude_self=False, digits=6):
    s = np.round(Q @ P.T, digits)
    out = set()
    for qi in range(Q.shape[0]):
        cand = [(-s[qi, pi], pi) for pi in range(P.shape[0]) if not (exclude_self and pi == qi)]
        for r, (neg, pi) in enumerate(sorted(cand)[:k], 1):
            out.add((qi, pi, round(-neg, digits), r))
    return out


def frames(spark, P, Q):
    p = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(P)],
                              "product_id long, embedding array<float>")
    q = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(Q)],
                              "query_id long, embedding array<double>")
    return p, q


def test_topk_matches_brute_force_with_ties(spark, monkeypatch):
    rng = np.random.default_rng(7)
    P = rng.normal(size=(60, 8)).astype(np.float32)
    P[10] = P[3]  # exact duplicates: ties broken by the smaller id
    P[11] = P[3]
    Q = P[:25].astype(np.float64)
    p, q = frames(spark, P, Q)
    for blocks in (2_048, 7):  # one block of each side, then many
        monkeypatch.setattr(retrieve, "BLOCK_ROWS", blocks)
        got = {(r.query_id, r.product_id, r.score, r.rank) for r in
               retrieve.vector_topk(p.repartition(3), q.repartition(2), 4, exclude_self=True).collect()}
        want = brute(P.astype(np.float64), Q, 4, exclude_self=True)
        assert {(a, b, d) for a, b, _, d in got} == {(a, b, d) for a, b, _, d in want}
        assert all(abs(x[2] - y[2]) < 1e-9 for x, y in zip(sorted(got), sorted(want)))


def test_topk_larger_k_extends_smaller(spark):
    rng = np.random.default_rng(1)
    P = rng.normal(size=(30, 4)).astype(np.float32)
    p, q = frames(spark, P, P[:5].astype(np.float64))
    k2 = {(r.query_id, r.product_id, r.rank) for r in retrieve.vector_topk(p, q, 2).collect()}
    k5 = {(r.query_id, r.product_id, r.rank) for r in retrieve.vector_topk(p, q, 5).collect()}
    assert k2 <= k5


def test_topk_fewer_products_than_k_and_empty(spark):
    P = np.eye(2, dtype=np.float32)
    p, q = frames(spark, P, P.astype(np.float64))
    assert retrieve.vector_topk(p, q, 5).count() == 4
    assert retrieve.vector_topk(p, q.limit(0), 3).count() == 0


def test_category_fallback(spark):
    rows = [(1, 10, "deposit", "saving"), (1, 11, "credit", "saving"), (1, 12, "rent", "saving"),
            (2, 20, "saving", "saving"), (2, 21, "rent", "saving"),
            (3, 30, "rent", ""), (3, 31, "credit", "")]
    df = spark.createDataFrame(rows, "query_id long, pid long, product_type string, target string")
    got = {(r.query_id, r.pid) for r in
           retrieve.category_fallback(df, "query_id", "product_type", "target").collect()}
    # q1: no hit -> all kept; q2: only the match; q3: no target -> all kept
    assert got == {(1, 10), (1, 11), (1, 12), (2, 20), (3, 30), (3, 31)}


def test_best_and_comparison(spark):
    df = spark.createDataFrame([("g", 1, 0.5, "a", "A"), ("g", 2, 0.9, "b", "B"),
                                ("g", 3, 0.9, "c", "C"), ("g", 4, 0.1, "d", "D")],
                               "g string, id long, s double, name string, co string")
    best = retrieve.best_per_group(df, ["g"], "s", "id", ["id"]).first()
    assert best.id == 2
    line = F.concat(F.lit("- "), F.col("name"), F.lit(" ("), F.col("co"), F.lit(")"))
    lines = retrieve.comparison_list(df, ["g"], [F.col("s").desc(), F.col("id")], 3, line).first()
    assert lines.lines == "- b (B)\n- c (C)\n- a (A)"


def test_l2_normalize_zero_is_null(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    got = [r.v for r in retrieve.l2_normalize(df, "v").collect()]
    assert got[0] == [0.6, 0.8] and got[1] is None


def test_hashing_encoder_is_unit_length(spark):
    docs = spark.createDataFrame([(1, "정기예금 추천"), (2, "적금 상품 비교"), (3, None)],
                                 "id long, text string")
    model = retrieve.fit_hashing_encoder(docs, "text", dim=16)
    rows = retrieve.embed(model, docs, "text").collect()
    assert all(len(r.embedding) == 16 for r in rows)
    n = np.linalg.norm(np.array(rows[0].embedding))
    assert abs(n - 1) < 1e-5


def test_embed_with_plugged_encoder(spark):
    docs = spark.createDataFrame([(1, "ab"), (2, "abcd")], "id long, text string")

    def factory():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])
    rows = retrieve.embed_with(docs, "text", factory, dim=2).orderBy("id").collect()
    assert np.allclose(rows[1].embedding, np.array([4, 1]) / np.sqrt(17), atol=1e-6)


def test_plugged_encoder_gets_full_batches_across_row_groups(spark):
    """Row groups of 10 rows, batches of 32: only a task's last call is smaller."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        docs = spark.range(0, 150, numPartitions=2).selectExpr("id", "CASE WHEN id % 7 > 0 THEN repeat('a', id) END AS text")

        def factory():
            calls = []

            def encode(texts):
                calls.append(len(texts))
                return np.array([[len(t), len(texts), len(calls)] for t in texts])
            return encode
        rows = retrieve.embed_with(docs, "text", factory, dim=3).orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert [r.id for r in rows] == list(range(150))
    for r in rows:
        n, batch, call = (x / r.embedding[2] for x in r.embedding)
        place = r.id % 75
        raw = np.array([0 if r.id % 7 == 0 else r.id, 32 if place < 64 else 11, place // 32 + 1], float)
        assert np.allclose(r.embedding, raw / np.linalg.norm(raw), atol=1e-5)


def test_words_are_hashed_once_for_fit_and_embedding(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"wort{i % 9} Wort{i % 4} x") for i in range(40)], "id long, text string")
    monkeypatch.setattr(retrieve, "MAX_WORDS", 3)       # the memory of words may be small
    _, both = retrieve.fit_embed(docs, "text", dim=16)
    apart = retrieve.embed(retrieve.fit_hashing_encoder(docs, "text", dim=16), docs, "text")
    assert {r.id: r.embedding for r in both.collect()} == {r.id: r.embedding for r in apart.collect()}


def test_topk_ranks_by_the_raw_score_and_starts_no_job(spark):
    """Doubles stay doubles, near-equal scores keep their order, and the plan
    is made without running anything."""
    p = spark.createDataFrame([(1, [0.12345651]), (2, [0.12345652]), (3, [0.1])],
                              "product_id long, embedding array<double>")
    q = spark.createDataFrame([(7, [1.0])], "query_id long, embedding array<double>")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("topk-plan", "")
    out = retrieve.vector_topk(p, q, 2, keep_raw=True)
    assert len(tracker.getJobIdsForGroup("topk-plan")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = [(r.product_id, r.raw_score, r.score) for r in out.orderBy("rank").collect()]
    assert got == [(2, 0.12345652, 0.123457), (1, 0.12345651, 0.123457)]


def test_payload_travels_with_winners_across_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    P = rng.normal(size=(40, 6)).astype(np.float32)
    p, q = frames(spark, P, P[:12].astype(np.float64))
    p = p.withColumn("label", (F.col("product_id") % 4).cast("int")).withColumn(
        "name", F.concat(F.lit("n"), F.col("product_id").cast("string")))
    for blocks in (2_048, 5):
        monkeypatch.setattr(retrieve, "BLOCK_ROWS", blocks)
        rows = retrieve.vector_topk(p, q, 3, payload=["label", "name"]).collect()
        assert len(rows) == 36
        assert all(r.label == r.product_id % 4 and r.name == f"n{r.product_id}" for r in rows)


def test_hashing_encoder_equals_plain_loops(spark):
    import hashlib
    import math
    import re
    from collections import Counter

    texts = ["정기예금 추천 추천 a1", "적금, 상품 비교 a1", None, "", "É é x_y", "a1 " * 9]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    _, emb = retrieve.fit_embed(docs, "text", dim=8)
    tf = [Counter(int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 8
                  for w in re.findall(r"[^\W_]+", (t or "").lower())) for t in texts]
    df = Counter(b for c in tf for b in c)
    for r in emb.collect():
        v = np.array([tf[r.id][b] * math.log((len(texts) + 1) / (df[b] + 1)) for b in range(8)])
        n = np.linalg.norm(v)
        assert np.allclose(r.embedding, v / n if n else v, atol=1e-6), r.id


def test_fit_embed_equals_fit_then_embed(spark):
    docs = spark.createDataFrame([(1, "정기예금 추천 상품"), (2, "적금 상품 비교"), (3, "대출 금리")],
                                 "id long, text string")
    model, emb = retrieve.fit_embed(docs, "text", dim=16)
    a = {r.id: r.embedding for r in emb.collect()}
    b = {r.id: r.embedding for r in retrieve.embed(model, docs, "text").collect()}
    c = {r.id: r.embedding for r in
         retrieve.embed(retrieve.fit_hashing_encoder(docs, "text", 16), docs, "text").collect()}
    assert a.keys() == b.keys() == c.keys()
    assert all(np.allclose(a[i], b[i]) and np.allclose(a[i], c[i]) for i in a)


def test_best_scores_in_small_pieces_and_breaks_ties():
    """a block pair must not hold its whole score matrix (several times)."""
    import tracemalloc

    rng = np.random.default_rng(5)
    P = rng.integers(-3, 4, size=(4000, 6)).astype(np.float64)      # many equal scores
    P[7, 0] = np.nan
    ids = rng.permutation(4000)
    Q = rng.integers(-3, 4, size=(3000, 6)).astype(np.float64)
    best = retrieve.Best(np.arange(3000), Q, 3, payload=1)
    tracemalloc.start()
    for lo, hi in ((0, 2), (2, 1500), (1500, 4000)):                # the first block has fewer than k
        best.meet(ids[lo:hi], P[lo:hi], lambda rows, lo=lo: [[f"p{x}" for x in ids[lo:][rows]]], exclude_self=True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6                      # one 4000 x 3000 matrix of doubles takes 96 MB
    s = P @ Q.T
    s[np.isnan(s)] = -np.inf
    s[ids[:, None] == np.arange(3000)[None, :]] = -np.inf
    for j in range(3000):
        want = np.lexsort((ids, -s[:, j]))[:3]
        assert best.ids[:, j].tolist() == ids[want].tolist()
        assert best.scores[:, j].tolist() == s[want, j].tolist()
        assert best.pay[0][:, j].tolist() == [f"p{x}" for x in ids[want]]


def test_fallback_over_a_single_partition_uses_all_cores(spark):
    """the search behind the fallback is not bound to the scan's partitions."""
    rng = np.random.default_rng(2)
    P = rng.normal(size=(90, 6)).astype(np.float32)
    p, q = frames(spark, P, P[:30].astype(np.float64))
    p = p.withColumn("label", (F.col("product_id") % 5).cast("int")).coalesce(1)
    top = retrieve.vector_topk(p, q.coalesce(1), 3, payload=["label"], exclude_self=True)
    assert "RoundRobinPartitioning(4)" in top._jdf.queryExecution().executedPlan().toString()
    kept = retrieve.category_fallback(top.withColumn("target", (F.col("query_id") % 5).cast("int")),
                                      "query_id", "label", "target", out_hit="hit").collect()
    want = brute(P.astype(np.float64), P[:30].astype(np.float64), 3, exclude_self=True)
    of = {}
    for qi, pi, _, r in want:
        of.setdefault(qi, []).append((pi, r))
    expected = {(qi, pi, r) for qi, found in of.items() for pi, r in found
                if pi % 5 == qi % 5 or all(x % 5 != qi % 5 for x, _ in found)}
    assert {(r.query_id, r.product_id, r["rank"]) for r in kept} == expected


def test_words_become_buckets_in_arrow_memory(monkeypatch):
    """a batch's words are not copied as Python strings, only new ones are."""
    import hashlib
    import tracemalloc

    import pyarrow as pa

    words = [f"wörd{i % 500}" for i in range(200_000)]
    col = pa.array([words[:150_000], [], words[150_000:]], pa.list_(pa.string())).slice(0)
    for at_a_time in (250_000, 70_001):
        monkeypatch.setattr(retrieve, "WORDS_AT_A_TIME", at_a_time)
        tracemalloc.start()
        got = retrieve._buckets(col, 64, {})
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 4e6                   # as strings, the words take over 10 MB
        want = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 64 for w in words]
        assert got.to_pylist() == [want[:150_000], [], want[150_000:]]
        assert retrieve._buckets(col.slice(1), 64, {}).to_pylist() == [[], want[150_000:]]


def test_packing_and_scoring_take_turns(spark, monkeypatch):
    """the blocks of both sides are dealt before they meet, so a task that
    scores has one worker, not two more that pack for it."""
    rng = np.random.default_rng(9)
    P = rng.normal(size=(90, 6)).astype(np.float32)
    P[40] = P[3]
    p, q = frames(spark, P, P[:50].astype(np.float64))
    monkeypatch.setattr(retrieve, "BLOCK_ROWS", 7)
    want = brute(P.astype(np.float64), P[:50].astype(np.float64), 3, exclude_self=True)
    for threshold in ("10485760", "-1"):                # broadcast queries, then a Cartesian product
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            top = retrieve.vector_topk(p.coalesce(1), q.coalesce(1), 3, exclude_self=True)
            steps = [s for line in top._jdf.queryExecution().executedPlan().toString().splitlines()
                     for s in ("score", "pack", "RoundRobin") if f"{s}(" in line or f"{s}Partitioning(" in line]
            assert steps == ["score", "RoundRobin", "pack", "RoundRobin", "pack"]
            assert {(r.query_id, r.product_id, r["rank"]) for r in top.collect()} == {(a, b, d) for a, b, _, d in want}
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
