"""Properties from the test strategy: results do not depend on physical
partitioning, dedup is idempotent, fallback never empties a group."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prodsearch.operators import clean, dialog, retrieve, stats


def same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_operators_ignore_partitioning(spark):
    rows = [(i % 7, i, f"t{i % 5}", float(i % 11)) for i in range(300)]
    df = spark.createDataFrame(rows, "g long, pos long, name string, x double")
    for n in (1, 5):
        r = df.repartition(n)
        assert same(clean.keep_first(df, ["g", "name"], ["pos"]),
                    clean.keep_first(r, ["g", "name"], ["pos"]))
        assert same(stats.top_values(df, ["g"], "name", 2), stats.top_values(r, ["g"], "name", 2))
        assert same(retrieve.best_per_group(df, ["g"], "x", "pos", ["pos"]),
                    retrieve.best_per_group(r, ["g"], "x", "pos", ["pos"]))
        m = df.select(F.col("g").alias("conv_id"), F.col("pos").alias("turn"),
                      F.lit("user").alias("role"), F.col("name").alias("text"))
        assert same(dialog.last_n(m, 3), dialog.last_n(m.repartition(n), 3))
        assert same(dialog.overflow_trim(m, 40), dialog.overflow_trim(m.repartition(n), 40))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", "c"]),
                          st.sampled_from(["a", "b", "c", ""])), min_size=1, max_size=30))
def test_fallback_never_empties_a_query(spark, rows):
    df = spark.createDataFrame([(q, i, t, tg) for i, (q, t, tg) in enumerate(rows)],
                               "query_id long, pid long, product_type string, target string")
    # one target per query, as in the job
    tgt = df.groupBy("query_id").agg(F.first("target").alias("t"))
    df = df.drop("target").join(tgt, "query_id")
    out = retrieve.category_fallback(df, "query_id", "product_type", "t")
    before = {r.query_id for r in df.select("query_id").distinct().collect()}
    after = {r.query_id for r in out.select("query_id").distinct().collect()}
    assert before == after


def test_keep_first_idempotent(spark):
    rng = np.random.default_rng(0)
    rows = [(int(i), f"c{rng.integers(3)}", f"p{rng.integers(4)}") for i in range(50)]
    df = spark.createDataFrame(rows, "pos long, co string, prd string")
    once = clean.keep_first(df, ["co", "prd"], ["pos"])
    assert same(once, clean.keep_first(once, ["co", "prd"], ["pos"]))


MARK = "상품명:"


def _py_marker_value(text, marker):
    """The list-based original: first line holding the marker, the text
    between it and the next marker on that line, stripped."""
    lines = [ln for ln in text.split("\n") if marker in ln]
    return lines[0].split(marker)[1].strip() if lines else None


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(st.sampled_from([MARK, "상품", "명", ":", "A", "b1", " ", "\n", "\r",
                                          "\t", "　", "\x1e", "\xa0"]),
                         max_size=12).map("".join), min_size=1, max_size=40))
def test_marker_value_matches_line_split(spark, texts):
    from prodsearch.functions import text as TX
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, v string")
    got = dict(df.select("i", TX.marker_value("v", TX.marker_regex(MARK, allow_bold=False)))
               .collect())
    assert [got[i] for i in range(len(texts))] == [_py_marker_value(t, MARK) for t in texts]


_FLOATS = st.one_of(
    st.floats(min_value=1e-300, max_value=1e16, exclude_max=True),
    st.floats(min_value=-1e16, max_value=-1e-300, exclude_min=True),
    st.sampled_from([0.0, -0.0, float("nan"), float("inf"), float("-inf")]))


@settings(max_examples=8, deadline=None)
@given(st.lists(_FLOATS, min_size=20, max_size=100))
def test_number_text_and_fixed_match_python(spark, vals):
    """str(float) and '%.3f' over generated doubles in their stated domains."""
    from prodsearch.functions import text as TX
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "i long, x double")
    got = {r.i: (r.t, r.f) for r in df.select(
        "i", TX.py_number_text("x").alias("t"), TX.fixed("x", 3).alias("f")).collect()}
    for i, v in enumerate(vals):
        assert got[i][0] == str(v)
        if v != v or abs(v) == float("inf") or abs(v) < 2.0 ** 52 / 1e3:
            assert got[i][1] == "%.3f" % v
