"""The cell index against the exact top-k."""

import numpy as np
import pytest

from prodsearch.operators import cells, retrieve


def clustered(spark, n, dim=16, centres=12, seed=1, kind="float"):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dim))
    v = c[rng.integers(0, centres, n)] + 0.15 * rng.normal(size=(n, dim))
    rows = [(i, [float(np.float32(x)) for x in r], f"n{i % 7}") for i, r in enumerate(v)]
    return spark.createDataFrame(rows, f"product_id long, embedding array<{kind}>, name string")


def rows(df):
    return sorted((r.query_id, r["rank"], r.product_id, round(r.score, 5)) for r in df.collect())


def both(spark, tmp_path, p, q, k=3, **kw):
    index = cells.build(p, str(tmp_path / "index"), payload=["name"])
    return index, retrieve.vector_topk(p, q, k, payload=["name"], **kw), kw


@pytest.mark.parametrize("kind", ["float", "double"])
def test_exact_mode_equals_the_exact_search(spark, tmp_path, kind):
    p = clustered(spark, 900, kind=kind)
    q = clustered(spark, 120, seed=2, kind=kind).selectExpr("product_id AS query_id", "embedding")
    index, exact, _ = both(spark, tmp_path, p, q)
    got = cells.topk(index, q, 3, probes=2, exact=True)
    assert got.columns == exact.columns
    assert rows(got) == rows(exact)
    names = {r.product_id: r.name for r in p.collect()}
    assert all(r.name == names[r.product_id] for r in got.collect())


def test_recall_and_work_on_clustered_vectors(spark, tmp_path):
    p = clustered(spark, 2000)
    q = p.selectExpr("product_id AS query_id", "embedding")
    index = cells.build(p, str(tmp_path / "index"))
    probes = cells.calibrate(index, q, 3, exclude_self=True)
    assert probes <= len(index.centres) // 3
    found = cells.topk(index, q, 3, probes=probes, exclude_self=True)
    r = cells.recall(found, retrieve.vector_topk(p, q, 3, exclude_self=True)).first()
    assert (r.n_queries, r.expected) == (2000, 6000) and r.recall >= 0.95
    # every vector is indexed, once
    saved = spark.read.parquet(index.path).selectExpr("explode(__id) AS id")
    assert saved.count() == saved.distinct().count() == 2000


def test_hot_cell_is_dealt_over_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cells, "BLOCK_ROWS", 50)
    same = spark.createDataFrame([(i, [1.0, 0.0, 0.001 * (i % 5)], "x") for i in range(700)]
                                 + [(1000 + i, [0.0, 1.0, float(i)], "y") for i in range(20)],
                                 "product_id long, embedding array<double>, name string")
    q = same.where("product_id % 20 = 0").selectExpr("product_id AS query_id", "embedding")
    index, exact, _ = both(spark, tmp_path, same, q, k=4)
    assert max(r.n for r in spark.read.parquet(index.path).selectExpr("size(__id) AS n").collect()) < 200
    assert rows(cells.topk(index, q, 4, exact=True)) == rows(exact)


def test_edges(spark, tmp_path):
    p = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0])], "product_id long, embedding array<double>")
    q = spark.createDataFrame([(7, [1.0, 1.0]), (8, None)], "query_id long, embedding array<double>")
    index = cells.build(p, str(tmp_path / "few"))
    assert rows(cells.topk(index, q, 5, exact=True)) == [(7, 1, 1, 1.0), (7, 2, 3, 0.0)]
    none = cells.build(p.limit(0), str(tmp_path / "none"))
    assert cells.topk(none, q, 3).count() == 0 and cells.calibrate(none, q) == 1
    assert cells.topk(index, q.limit(0), 3, exact=True).count() == 0


def loose(spark, n, seed=4, dim=16):
    v = np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)
    return spark.createDataFrame([(i, [float(x) for x in r], f"n{i % 7}") for i, r in enumerate(v)],
                                 "product_id long, embedding array<float>, name string")


def test_exact_mode_of_loose_vectors_in_many_groups(spark, tmp_path, monkeypatch):
    """vectors without structure visit nearly all cells; a query's vector
    goes once to each group of cells, and groups and query parts are bounded."""
    monkeypatch.setattr(cells, "GROUP_ROWS", 150)
    monkeypatch.setattr(cells, "BLOCK_ROWS", 40)
    p = loose(spark, 700)
    q = p.selectExpr("product_id AS query_id", "embedding")
    index, exact, kw = both(spark, tmp_path, p, q, exclude_self=True)
    groups = int(cells._groups(index)[2][-1]) + 1
    assert groups == 5 and len(index.centres) > 20
    asked = q.selectExpr("query_id AS qid", "embedding AS v", "CAST(NULL AS double) AS kth")
    every = cells._visits(index, asked, "<f4", lambda m, _least, c, _r: np.ones((len(m), len(c)), bool))
    assert every.count() == 700 * groups
    assert rows(cells.topk(index, q, 3, exact=True, **kw)) == rows(exact)


def test_probes_of_loose_vectors_reach_the_recall_in_many_groups(spark, tmp_path, monkeypatch):
    """most cells are probed, and each visit names its group's cells only."""
    monkeypatch.setattr(cells, "GROUP_ROWS", 150)
    p = loose(spark, 600)
    q = p.selectExpr("product_id AS query_id", "embedding")
    index, exact, kw = both(spark, tmp_path, p, q, exclude_self=True)
    probes = cells.calibrate(index, q, 3, **kw)
    assert 1 < probes <= len(index.centres)
    found = cells.topk(index, q, 3, probes=probes, **kw)
    r = cells.recall(found, exact).first()
    assert (r.n_queries, r.expected) == (600, 1800) and r.recall >= 0.95
    whole = cells.topk(index, q, 3, probes=len(index.centres), **kw)
    assert rows(whole) == rows(exact)
    one = cells.topk(index, q, 3, probes=1, **kw)
    assert cells.recall(one, exact).first().recall < 0.95       # cells not asked for stay out


def test_all_steps_look_at_a_slice_of_rows(spark, monkeypatch):
    """a row meets every centre, so batches are cut before they do."""
    import pyarrow as pa

    b = pa.RecordBatch.from_arrays([pa.array(range(5000))], ["x"])
    parts = list(cells._slices(b))
    assert max(p.num_rows for p in parts) <= cells.BLOCK_ROWS and sum(p.num_rows for p in parts) == 5000
