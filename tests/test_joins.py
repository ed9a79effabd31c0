"""Record joins, option-only fallback, grounding, containment."""

from pyspark.sql import functions as F

from prodsearch.operators import joins


def base_opt(spark):
    base = spark.createDataFrame(
        [("c1", "A1", "n1", "x"), ("c1", "A2", "n2", "x"), ("c2", None, "n3", "x")],
        "fin_co_no string, fin_prdt_cd string, fin_prdt_nm string, dcls_month string")
    opt = spark.createDataFrame(
        [("c1", "A1", "6", "y"), ("c1", "A1", "12", "y"), ("c1", "A1", "24", "y"),
         ("c9", None, "3", "y"), ("c1", "B9", "1", "y")],
        "fin_co_no string, fin_prdt_cd string, save_trm string, dcls_month string")
    return base, opt


def test_fan_out_no_option_and_suffixes(spark):
    base, opt = base_opt(spark)
    out = joins.left_join_records(base, opt, ["fin_prdt_cd"])
    assert set(out.columns) == {"fin_co_no_x", "fin_prdt_cd", "fin_prdt_nm", "dcls_month_x",
                                "fin_co_no_y", "save_trm", "dcls_month_y"}
    rows = out.collect()
    assert len([r for r in rows if r.fin_prdt_cd == "A1"]) == 3
    a2 = [r for r in rows if r.fin_prdt_cd == "A2"]
    assert len(a2) == 1 and a2[0].save_trm is None
    # null keys do not match by default ...
    assert [r.save_trm for r in rows if r.fin_prdt_nm == "n3"] == [None]
    # ... and do in compat (null-safe) mode
    nulls = joins.left_join_records(base, opt, ["fin_prdt_cd"], null_safe=True)
    assert [r.save_trm for r in nulls.collect() if r.fin_prdt_nm == "n3"] == ["3"]


def test_row_count_property(spark):
    base, opt = base_opt(spark)
    out = joins.left_join_records(base, opt, ["fin_prdt_cd"]).count()
    matches = {"A1": 3, "A2": 0, None: 0}
    assert out == sum(max(1, matches[k]) for k in ["A1", "A2", None])


def test_same_code_two_companies(spark):
    base = spark.createDataFrame([("c1", "X"), ("c2", "X")], "co string, cd string")
    opt = spark.createDataFrame([("c1", "X", 1), ("c2", "X", 2)], "co string, cd string, t int")
    assert joins.left_join_records(base, opt, ["cd"]).count() == 4
    assert joins.left_join_records(base, opt, ["co", "cd"]).count() == 2


def test_option_only_fallback(spark):
    base = spark.createDataFrame([("g1", "k1", "b")], "g string, k string, bv string")
    opt = spark.createDataFrame([("g1", "k1", "o1"), ("g1", "k9", "o2"), ("g2", "k5", "o3")],
                                "g string, k string, ov string")
    rows = {(r.g, r.k, r.bv, r.ov) for r in joins.option_only_fallback(base, opt, ["k"], ["g"])
            .collect()}
    # g1 has a base: left join, its unmatched option k9 is dropped;
    # g2 has none: its options pass through with null base columns
    assert rows == {("g1", "k1", "b", "o1"), ("g2", "k5", None, "o3")}


def test_option_only_both_empty(spark):
    base = spark.createDataFrame([], "g string, k string, bv string")
    opt = spark.createDataFrame([], "g string, k string, ov string")
    assert joins.option_only_fallback(base, opt, ["k"], ["g"]).count() == 0


def test_label_lookup_falls_back_to_code(spark):
    df = spark.createDataFrame([("deposit",), ("other",)], "t string")
    dim = joins.code_list(spark, {"deposit": "정기예금"})
    got = {r.t: r.label for r in joins.label_lookup(df, "t", dim, "code", "label").collect()}
    assert got == {"deposit": "정기예금", "other": "other"}


def test_grounding(spark):
    answers = spark.createDataFrame([(1, 1, "추천: 상품A 입니다"), (1, 2, "없음"), (2, 1, "상품B")],
                                    "q long, a long, text string")
    cands = spark.createDataFrame([(1, "상품A"), (1, "상품C"), (1, "상품A")],
                                  "q long, name string")
    got = {(r.q, r.a): r.grounded
           for r in joins.grounding(answers, cands, "q", "a", "text", "name").collect()}
    assert got == {(1, 1): 1, (1, 2): 0, (2, 1): None}


def test_containment_matches_brute_force(spark):
    import random
    rng = random.Random(5)
    texts = ["abc hello world", "nothing here", "worldworld", "héllo wörld", None, "", "a b  c", "x\ty z", "hello"]
    pats = ["hello", "world", "wörld", "zzz", "lo wor", "o w", "b  c", "b c", "x\ty", " c", "h", "hello world x"]
    alphabet = ["ab", "b", "cab", "é", " ", " ", "  ", "\n"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 20))) for _ in range(60)]
    pats += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 6))) for _ in range(60)]
    pats = [q for q in pats if q.split()]
    t = spark.createDataFrame(list(enumerate(texts)), "tid long, text string")
    # patterns of white space only, empty or null match nothing
    p = spark.createDataFrame([*enumerate(pats), (900, ""), (901, " "), (902, None)], "pid long, p string")
    out = joins.containment_join(t, p, "tid", "text", "pid", "p")
    got = [(r.tid, r.pid) for r in out.collect()]
    want = {(i, j) for i, s in enumerate(texts) if s is not None
            for j, q in enumerate(pats) if q in s}
    assert len(got) == len(set(got)) and set(got) == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" not in plan and "PythonUDF" not in plan


def test_empty_inputs(spark):
    e = spark.createDataFrame([], "k long, v string")
    assert joins.left_join_records(e, e.withColumnRenamed("v", "w"), ["k"]).count() == 0
    assert joins.containment_join(e, e, "k", "v", "k", "v").count() == 0
    g = joins.grounding(e.withColumn("t", F.lit("x")), e, "k", "k", "t", "v")
    assert g.count() == 0


def test_salted_left_join_equals_plain(spark):
    base = spark.createDataFrame([("hot", 1), ("cold", 2), ("none", 3), (None, 4), ("hot", 5)],
                                 "k string, b int")
    opt = spark.createDataFrame([("hot", i) for i in range(57)] + [("cold", 100), ("zzz", 7),
                                                                   (None, 8)], "k string, o int")
    plain = joins.left_join_records(base, opt, ["k"])
    salted = joins.left_join_records(base, opt, ["k"], hot_rows=10)
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, salted.collect()),
                                                                  key=str)
    assert salted.count() == 57 * 2 + 1 + 1 + 1
    # salt from an option row id only; the id column also exists on the base
    # side (renamed to o_y), and the hot key is still split over salts
    base2 = base.withColumn("o", F.lit(0))
    by_id = joins.left_join_records(base2, opt, ["k"], hot_rows=10, salt_cols=["o"])
    plain2 = joins.left_join_records(base2, opt, ["k"])
    assert sorted(map(tuple, plain2.collect()), key=str) == sorted(map(tuple, by_id.collect()),
                                                                   key=str)


def test_collect_tables_reads_only_needed_columns(spark, tmp_path):
    from prodsearch.plans import collect
    base = spark.createDataFrame([(k, "F" if k % 2 else "O", f"c{k}") for k in range(20)],
                                 "k long, div string, note string")
    opt = spark.createDataFrame([(k % 5, i, f"long text {i}", float(i)) for k, i in
                                 zip(range(200), range(200))],
                                "k long, line long, txt string, amount double")
    src = str(tmp_path / "opt")
    opt.write.parquet(src)
    opt = spark.read.parquet(src)
    out = collect.collect_tables(base, opt, "k", "div", hot_rows=10, row_id=["line"])
    whole = collect.collect_tables(base, opt, "k", "div", hot_rows=10)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, whole.collect()))
    import io
    from contextlib import redirect_stdout
    buf = io.StringIO()
    with redirect_stdout(buf):
        out.explain("formatted")
    schemas = [ln for ln in buf.getvalue().splitlines() if ln.startswith("ReadSchema")]
    assert schemas and all("txt" not in ln and "amount" not in ln for ln in schemas)


def test_grounding_many_names_null_and_blank(spark):
    rows = [(1, i, f"답변 상품{i % 40} 추천") for i in range(60)] + [
        (2, 0, "없음"), (3, 0, "x"), (4, 0, "두 단어 이름"), (5, 0, "x"), (6, 0, "a b"), (6, 1, "ab"), (7, 0, None)]
    answers = spark.createDataFrame(rows, "q long, a long, text string")
    names = [(1, f"상품{i}") for i in range(0, 80, 2)] + [
        (2, "없"), (3, ""), (4, "단어 이"), (5, None), (6, " "), (7, "x"), (1, None)]
    got = [((r.q, r.a), r.grounded) for r in joins.grounding(
        answers, spark.createDataFrame(names, "q long, name string"), "q", "a", "text", "name").collect()]
    want = {(q, a): int(any(n is not None and t is not None and n in t for k, n in names if k == q))
            for q, a, t in rows}
    assert len(got) == len(rows) and dict(got) == want


def test_salted_left_join_null_safe(spark):
    base = spark.createDataFrame([("hot", 1), (None, 4), ("hot", 5), ("none", 2)], "k string, b int")
    opt = spark.createDataFrame([("hot", i) for i in range(57)] + [(None, 90 + i) for i in range(31)],
                                "k string, o int")
    for safe in (False, True):
        plain = joins.left_join_records(base, opt, ["k"], null_safe=safe)
        salted = joins.left_join_records(base, opt, ["k"], null_safe=safe, hot_rows=10, salt_cols=["o"])
        assert sorted(map(str, salted.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_classify_by_table_equals_expressions(spark):
    from prodsearch.functions import text as TX
    tax = [("deposit", ["tion", "ment"]), ("saving", ["und", "sch"]), ("credit", ["que", "les"])]
    docs = spark.createDataFrame(
        [(1, "Station of movement"), (2, "und Schule que"), (3, "nothing"), (4, "QUE les und"),
         (5, None)], "doc_id long, text string")
    tdf = spark.createDataFrame([(lab, i, k) for i, (lab, ks) in enumerate(tax, 1) for k in ks],
                                "label string, ord int, kw string")
    by_table = {r.doc_id: r.label for r in joins.classify_by_table(docs, "doc_id", "text", tdf)
                .collect()}
    by_expr = {r.doc_id: r.label for r in
               docs.select("doc_id", TX.classify_by_keywords("text", tax).alias("label")).collect()}
    assert by_table == by_expr == {1: "deposit", 2: "saving", 3: "", 4: "credit", 5: ""}


def test_broadcast_guard_checks_rows_and_bytes(spark):
    import io
    from contextlib import redirect_stdout

    from prodsearch.operators import guard

    dim = spark.createDataFrame([(i, "x" * 100) for i in range(50)], "k long, v string")
    assert guard.size_at_most(dim, 50, 1 << 20)[0] == 50
    assert guard.size_at_most(dim, 49, 1 << 20) is None           # too many rows
    assert guard.size_at_most(dim, 50, 1000) is None              # too many bytes
    assert guard.size_at_most(dim.where("k < 0"), 10, 10) == (0, 0)
    facts = spark.range(1000).withColumnRenamed("id", "k")

    def plan(df):
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain()
        return buf.getvalue()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = facts.join(guard.broadcast_if_small(dim, 100), "k")
        wide = facts.join(guard.broadcast_if_small(dim, 100, max_bytes=1000), "k")
        assert "BroadcastHashJoin" in plan(small)
        assert "BroadcastHashJoin" not in plan(wide)
        assert small.count() == wide.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
