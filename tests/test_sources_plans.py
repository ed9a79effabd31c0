"""Sources, sinks, end-to-end jobs and the incremental landing stream."""

import json
import os
import shutil

from pyspark.sql import functions as F

from prodsearch import schemas as S
from prodsearch.plans import collect, preprocess, recommend
from prodsearch.sources import files, pages
from prodsearch.streaming import landing


def land(root, snapshot=None, api="deposit", region="020000", page=1, result=None, raw=None):
    parts = [root] + ([f"snapshot_ts={snapshot}"] if snapshot else []) + [
        f"api={api}", f"region_code={region}", f"pageNo={page}"]
    d = os.path.join(*parts)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "page.json"), "w", encoding="utf-8") as f:
        f.write(raw if raw is not None else json.dumps({"result": result}, ensure_ascii=False))


def deposit_result(page, max_page, base, options, total=2):
    return {"total_count": total, "max_page_no": max_page, "now_page_no": page, "prdt_div": "D",
            "baseList": base, "optionList": options}


def landing_fixture(root, snapshot=None):
    b1 = {"fin_co_no": "c1", "fin_prdt_cd": "A1", "kor_co_nm": "가나은행", "fin_prdt_nm": "예금1",
          "dcls_month": "202501"}
    b2 = {"fin_co_no": "c1", "fin_prdt_cd": "A2", "kor_co_nm": "가나은행", "fin_prdt_nm": "예금2",
          "dcls_month": "202501"}
    o = [{"fin_co_no": "c1", "fin_prdt_cd": "A1", "save_trm": str(t), "intr_rate": "3.1",
          "dcls_month": "202501"} for t in (6, 12)]
    land(root, snapshot, page=1, result=deposit_result(1, 2, [b1], o[:1]))
    land(root, snapshot, page=2, result=deposit_result(2, 2, [b2], o[1:]))
    # a sector with one failed page: dropped whole
    land(root, snapshot, region="030300", page=1,
         result=deposit_result(1, 2, [b1], o))
    land(root, snapshot, region="030300", page=2, raw='{"result": ')
    # options without any base in their group: kept as they are
    land(root, snapshot, api="saving", region="050000", page=1,
         result={"total_count": 1, "max_page_no": 1, "now_page_no": 1, "prdt_div": "S",
                 "baseList": [], "optionList": [{"fin_prdt_cd": "Z", "save_trm": "24"}]})


def test_collect_landing(spark, scratch):
    landing_fixture(scratch)
    recs, counts, bad = collect.collect_landing(spark, scratch, "20250714_175227")
    rows = recs.collect()
    d = [r for r in rows if r.prdt_div == "D"]
    assert len(d) == 3  # A1 x 2 options + A2 with none
    assert {r.region_name for r in d} == {S.REGION_CODES["020000"]}
    a1 = [r.rec for r in d if r.rec["fin_prdt_cd"] == "A1"]
    assert {m["save_trm"] for m in a1} == {"6", "12"}
    assert "dcls_month_x" in a1[0] and "dcls_month_y" in a1[0] and "fin_co_no_y" in a1[0]
    s = [r for r in rows if r.prdt_div == "S"]
    assert len(s) == 1 and s[0].rec["save_trm"] == "24"
    c = {r.prdt_div: (r.records, r.reported) for r in counts.collect()}
    assert c == {"D": (3, 2), "S": (1, 1)}
    assert bad.count() == 1


def test_option_only_record_keeps_its_code(spark, scratch):
    landing_fixture(scratch)
    recs, _, _ = collect.collect_landing(spark, scratch, "20250714_175227")
    assert [r.rec for r in recs.where("prdt_div = 'S'").collect()] == [{"fin_prdt_cd": "Z", "save_trm": "24"}]


def test_suffixes_are_the_groups(spark, scratch):
    """A base row without options has the same column names as its group."""
    landing_fixture(scratch)
    recs, _, _ = collect.collect_landing(spark, scratch, "20250714_175227")
    rows = [r.rec for r in recs.where("prdt_div = 'D'").collect()]
    assert all("dcls_month_x" in m and "dcls_month" not in m and "fin_co_no_x" in m for m in rows)
    assert {m["fin_prdt_cd"] for m in rows if "save_trm" not in m} == {"A2"}


def test_envelope_defaults_and_pages_landed_twice(spark, scratch):
    land(scratch, api="deposit", result={"total_count": 1, "baseList": [{"fin_prdt_cd": "A"}],
                                         "optionList": [{"fin_prdt_cd": "A", "save_trm": "6"}]})
    again = os.path.join(scratch, "api=deposit", "region_code=020000", "pageNo=1")
    shutil.copy(os.path.join(again, "page.json"), os.path.join(again, "retry.json"))
    with open(os.path.join(again, "early.json"), "w") as f:
        f.write('{"result": ')
    recs, counts, bad = collect.collect_landing(spark, scratch, "20250714_175227")
    assert [(r.prdt_div, r.rec) for r in recs.collect()] == [("deposit", {"fin_prdt_cd": "A", "save_trm": "6"})]
    assert [(r.records, r.reported) for r in counts.collect()] == [(1, 1)] and bad.count() == 1


def test_collect_parses_pages_once(spark, scratch):
    landing_fixture(os.path.join(scratch, "land"))
    recs, counts, _ = collect.collect_landing(spark, os.path.join(scratch, "land"), "20250714_175227")
    for df in (recs, counts):
        assert df._jdf.queryExecution().executedPlan().toString().count("FileScan json") == 0
    out = os.path.join(scratch, "out")
    got = {r.prdt_div: (r.records, r.reported) for r in collect.collect_job(
        spark, os.path.join(scratch, "land"), out, "20250714_175227").collect()}
    assert got == {"D": (3, 2), "S": (1, 1)}


def test_csv_columns_go_by_header(spark, scratch):
    from pyspark.sql import types as T
    import pytest
    d = os.path.join(scratch, "one")
    os.makedirs(d)
    with open(os.path.join(d, "D_20250714_175227.csv"), "w", encoding="utf-8-sig") as f:
        f.write("dcls_month,kor_co_nm,x\n202501,은행A,1.5\n")
    want = T.StructType.fromDDL("kor_co_nm string, dcls_month string, x double, absent string")
    assert [tuple(r) for r in files.read_raw_csv(spark, d, want).collect()] == [("은행A", "202501", 1.5, None)]
    with open(os.path.join(d, "S_20250714_175227.csv"), "w", encoding="utf-8-sig") as f:
        f.write("kor_co_nm,dcls_month,x\n은행B,202502,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_raw_csv(spark, d, want).collect()


def test_csv_roundtrip_quirks(spark, scratch):
    path = os.path.join(scratch, "D_20250714_175227.csv")
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write('kor_co_nm,fin_prdt_nm,spcl_cnd,intr_rate\n')
        f.write('은행A,"예금 ""특판""","첫 줄\n둘째 줄",N/A\n')
    df = files.with_snapshot(files.read_raw_csv(spark, scratch))
    r = df.first()
    assert df.count() == 1
    assert r.kor_co_nm == "은행A" and r.fin_prdt_nm == '예금 "특판"'
    assert r.spcl_cnd == "첫 줄\n둘째 줄" and r.intr_rate is None
    assert (r.prdt_div, r.snapshot_ts) == ("D", "20250714_175227")


def test_write_raw_empty_writes_nothing(spark, scratch):
    e = spark.createDataFrame([], "prdt_div string, snapshot_ts string, v string")
    assert files.write_raw(e, os.path.join(scratch, "out")) is False
    assert not os.path.exists(os.path.join(scratch, "out"))


def test_latest_per_group_keeps_ties(spark):
    df = spark.createDataFrame([("D", "1"), ("D", "2"), ("D", "2"), ("S", "1")], "d string, ts string")
    assert sorted(tuple(r) for r in files.latest_per_group(df, ["d"], "ts").collect()) == [
        ("D", "2"), ("D", "2"), ("S", "1")]


def test_run_per_type_isolates_failures(spark):
    def job(t):
        if t == "saving":
            raise RuntimeError("boom")
        if t == "rent":
            return None
        return spark.range(3)
    st = {r.product_type: r.status for r in
          files.run_per_type(spark, ["deposit", "saving", "rent"], job).collect()}
    assert st == {"deposit": "ok", "saving": "failed", "rent": "missing"}


def test_preprocess_deposit(spark):
    rows = [("가나은행 ", "예금A", "3.5", "4.0", "12", "10000000"),
            ("가나은행", "예금A", "3.6", "4.1", "24", None),   # duplicate: dropped
            (None, "예금B", "1", "1", "6", None),             # no company: dropped
            ("　다라은행", "예금C", "bad", "2.0", "6", None)]
    df = spark.createDataFrame(rows, "kor_co_nm string, fin_prdt_nm string, intr_rate string, "
                                     "intr_rate2 string, save_trm string, max_limit string")
    out = preprocess.preprocess_product(df.coalesce(1), "deposit")
    got = {r.kor_co_nm: r for r in out.collect()}
    assert set(got) == {"가나은행", "다라은행"}
    a = got["가나은행"]
    assert a.intr_rate == 3.5 and a.save_trm == "12"
    assert a.search_text.splitlines()[:3] == ["상품명: 예금A", "금융회사: 가나은행", "기본금리: 3.5%"]
    assert "최고한도: 10000000" in a.search_text and "우대조건: N/A" in a.search_text
    assert got["다라은행"].intr_rate is None
    stats = preprocess.product_statistics(out, "deposit", "2025-07-14 17:52:27")
    assert stats["counts"].first().n_products == 2
    rates = {r.metric: r.range for r in stats["rates"].collect()}
    assert rates["intr_rate"] == "3.50% ~ 3.50%"


def test_preprocess_annuity_blank_flags_and_compat(spark):
    df = spark.createDataFrame([("c", "p", None, "고정"), ("c", "q", "  ", None)],
                               "kor_co_nm string, fin_prdt_nm string, etc string, "
                               "pnsn_kind_nm string")
    out = preprocess.preprocess_product(df, "annuity")
    assert {(r.etc_available, r.etc_clean) for r in out.collect()} == {(False, "")}
    m = spark.createDataFrame([("c", "p", "고정금리")],
                              "kor_co_nm string, fin_prdt_nm string, lend_rate_type_nm string")
    assert preprocess.preprocess_product(m, "mortgage").first().lend_rate_type_nm == "고정금리"
    assert preprocess.preprocess_product(m, "mortgage", compat=True).first().lend_rate_type_nm \
        is None


def test_recommend_end_to_end(spark):
    products = spark.createDataFrame(
        [(1, "deposit", "은행A", "예금1", [1.0, 0.0]), (2, "saving", "은행B", "적금1", [0.9, 0.1]),
         (3, "deposit", "은행C", "예금2", [0.0, 1.0])],
        "product_id long, product_type string, company string, product_name string, "
        "embedding array<float>").withColumn("raw_data", F.create_map(F.lit("k"), F.lit("v")))
    queries = spark.createDataFrame(
        [(10, 1, "적금 추천해줘", [1.0, 0.0]), (11, 2, "정기예금 비교", [1.0, 0.05])],
        "query_id long, conv_id long, text string, embedding array<double>")
    msgs = spark.createDataFrame([(1, 0, "user", "안녕"), (1, 1, "assistant", "📍 추천 상품: 예금1")],
                                 "conv_id long, turn long, role string, text string")
    answers = spark.createDataFrame([(10, "적금1 을 추천합니다", "base"), (11, "모름", "")],
                                    "query_id long, generated string, fallback string")
    out = recommend.recommend(products, queries, msgs, answers, k=2)
    res = out["results"]
    assert {r.product_id for r in res.where("query_id = 10").collect()} == {2}  # saving only
    assert {r.product_id for r in res.where("query_id = 11").collect()} == {1}  # deposit hit
    prompts = {r.query_id: r for r in out["prompts"].collect()}
    assert {q: r.route for q, r in prompts.items()} == {10: "recommendation", 11: "comparison"}
    assert prompts[10].prompt.startswith(S.CONTEXT_NOTE_PREFIX)  # conv 1 had a marked answer
    final = {r.query_id: r.recommendation for r in out["final"].collect()}
    assert final == {10: "적금1 을 추천합니다", 11: S.GENERATION_ERROR_MESSAGE}
    resp = {r.query_id: (r.status, r.conversation_turns) for r in out["responses"].collect()}
    assert resp[10] == ("success", 2)


def test_bad_analysis_json_routes_to_information(spark):
    df = spark.createDataFrame([(1, "```json {}```"), (2, "[1]"), (3, '{"product_category": "적금"'),
                                (4, '{"product_category": "적금", "user_intent": "comparison"}')],
                               "id long, raw string")
    a = recommend.analysis_from_json(df, "raw")
    rows = {r.id: r for r in a.collect()}
    assert rows[1].analysis_error.status == "json_parse_error"
    assert rows[2].analysis_error is not None and rows[3].analysis_error is not None
    assert rows[4].analysis.user_intent == "comparison" and rows[4].analysis_error is None
    route = a.select("id", F.when(F.col("analysis_error").isNotNull(), None)
                     .otherwise(F.col("analysis.user_intent")).alias("i"))
    from prodsearch.functions import text as TX
    r = {x.id: x.r for x in route.select("id", TX.route_intent("i", F.lit("")).alias("r")).collect()}
    assert r[1] == "information" and r[4] == "comparison"


def test_stream_replay_equals_batch(spark, scratch):
    root = os.path.join(scratch, "landing")
    staging = os.path.join(scratch, "staging")
    landing_fixture(os.path.join(staging, "a"))
    os.makedirs(root, exist_ok=True)
    shutil.move(os.path.join(staging, "a"), os.path.join(root, "snapshot_ts=20250101_000000"))
    out = os.path.join(scratch, "out")
    q = landing.start(spark, root, out, os.path.join(scratch, "ckpt"))
    q.awaitTermination(120)
    streamed = landing.newest_records(spark, out)
    batch, _, _ = collect.collect_landing(
        spark, os.path.join(root, "snapshot_ts=20250101_000000"), "20250101_000000")
    key = ["prdt_div", "api", "region_code"]
    s = sorted((r.prdt_div, r.api, r.region_code, tuple(sorted(r.rec.items())))
               for r in streamed.select(*key, "rec").collect())
    b = sorted((r.prdt_div, r.api, r.region_code, tuple(sorted(r.rec.items())))
               for r in batch.select(*key, "rec").collect())
    assert s == b and len(s) == 4
    # a second run with nothing new changes nothing
    q2 = landing.start(spark, root, out, os.path.join(scratch, "ckpt"))
    q2.awaitTermination(120)
    assert landing.newest_records(spark, out).count() == 4


def test_stream_in_single_file_batches_equals_batch(spark, scratch):
    """Every page in a micro-batch of its own: nothing is lost, counts are
    written, and a replayed batch changes nothing."""
    root, out = os.path.join(scratch, "landing"), os.path.join(scratch, "out")
    landing_fixture(os.path.join(root, "snapshot_ts=20250101_000000"))
    landing.start(spark, root, out, os.path.join(scratch, "ckpt"), max_files=1).awaitTermination(300)
    batch, counts, bad = collect.collect_landing(
        spark, os.path.join(root, "snapshot_ts=20250101_000000"), "20250101_000000")

    def rows(df):
        return sorted((r.prdt_div, r.api, r.region_code, tuple(sorted(r.rec.items()))) for r in df.collect())

    assert rows(landing.newest_records(spark, out)) == rows(batch)
    written = spark.read.parquet(f"{out}/counts")
    assert sorted((r.prdt_div, r.records, r.reported) for r in written.collect()) == sorted(
        (r.prdt_div, r.records, r.reported) for r in counts.collect())
    assert spark.read.parquet(f"{out}/quarantine").count() == bad.count() == 1
    pages = spark.read.schema(landing.stream_schema().add("file", "string")).parquet(f"{out}/pages/epoch=0")
    pages = spark.createDataFrame(pages.collect(), pages.schema)
    landing.process_batch(pages, 0, out)
    replayed = rows(landing.newest_records(spark, out))
    landing.process_batch(pages, 0, out)
    assert rows(landing.newest_records(spark, out)) == replayed


def test_stream_checkpoint_defaults_to_shared_folder(spark, scratch):
    from prodsearch.session import ensure_checkpoint_dir
    root = os.path.join(scratch, "landing_default")
    os.makedirs(root, exist_ok=True)
    landing_fixture(os.path.join(root, "snapshot_ts=20250101_000000"))
    out = os.path.join(scratch, "out_default")
    q = landing.start(spark, root, out)
    q.awaitTermination(120)
    assert landing.newest_records(spark, out).count() == 4
    ckpt = ensure_checkpoint_dir(spark).rstrip("/")
    if ckpt.startswith("file:"):
        ckpt = ckpt[len("file:"):]
    assert os.path.isdir(os.path.join(ckpt, "landing-stream", "offsets"))


def test_pages_pack_and_explode(spark):
    base = spark.createDataFrame([(1, "b1"), (2, "b2")], "k long, bv string")
    opt = spark.createDataFrame([(1, i, float(i)) for i in range(7)] + [(3, 0, 0.5)],
                                "k long, n int, x double")
    env = pages.pack_pages(base, opt, "k", division="D", page_size=3)
    parsed = pages.parse_pages(env, "page_json")
    assert parsed.where(F.col("result.max_page_no") == 3).count() >= 1
    recs = pages.explode_records(parsed, "optionList", group=["k"])
    got = pages.records_to_columns(recs.drop("k"), ["k", "n", "x"],
                                   {"k": "bigint", "n": "int", "x": "double"})
    assert sorted(tuple(r) for r in got.select("k", "n", "x").collect()) == sorted(
        tuple(r) for r in opt.collect())


def test_pipeline_landing_to_answers(spark, scratch):
    """Landing -> collect -> per-type preprocess -> processed files ->
    documents -> embeddings -> batch recommend, all on Spark."""
    landing_fixture(os.path.join(scratch, "land"))
    recs, _, _ = collect.collect_landing(spark, os.path.join(scratch, "land"), "20250101_000000")
    assert files.write_raw(recs, os.path.join(scratch, "raw_csv"), fmt="csv")
    raw_back = spark.read.option("header", True).csv(os.path.join(scratch, "raw_csv"))
    assert "save_trm" in raw_back.columns and raw_back.count() == 4
    dep = preprocess.preprocess_product(preprocess.from_records(recs, "deposit"), "deposit")
    sav = preprocess.preprocess_product(preprocess.from_records(recs, "saving"), "saving")
    assert dep.count() == 2 and sav.count() == 0  # the saving option has no company/name
    out = os.path.join(scratch, "processed")
    files.write_processed(files.union_typed({"deposit": dep, "saving": sav}).drop("_pos"), out)
    docs = recommend.product_documents(spark.read.parquet(out))
    from prodsearch.operators import retrieve
    model = retrieve.fit_hashing_encoder(docs, "search_text", dim=32)
    prods = retrieve.embed(model, docs, "search_text")
    qs = spark.createDataFrame([(1, 7, "예금1 정기예금 추천해줘")], "query_id long, conv_id long, text string")
    qs = retrieve.embed(model, qs, "text")
    res = recommend.recommend(prods, qs, k=2)
    top = res["results"].orderBy("rank").first()
    assert top.product_name == "예금1" and top.raw_data["kor_co_nm"] == "가나은행"
    assert res["prompts"].first().route == "recommendation"


def test_keep_first_follows_collection_order(spark, scratch):
    """Two sectors hold the same product; page 2 of the first sector comes
    before anything of the second, and the first option row wins."""
    b = {"fin_co_no": "c1", "fin_prdt_cd": "A1", "kor_co_nm": "은행", "fin_prdt_nm": "예금"}
    opts = [{"fin_prdt_cd": "A1", "save_trm": t, "intr_rate": r} for t, r in
            (("12", "3.0"), ("6", "2.5"))]
    land(scratch, region="030300", page=1, result=deposit_result(1, 1, [b], opts[1:]))
    land(scratch, region="020000", page=1, result=deposit_result(1, 2, [], []))
    land(scratch, region="020000", page=2, result=deposit_result(2, 2, [b], opts))
    recs, _, _ = collect.collect_landing(spark, scratch, "20250101_000000")
    out = preprocess.preprocess_product(preprocess.from_records(recs, "deposit").repartition(3),
                                        "deposit")
    r = out.first()
    assert out.count() == 1 and r.save_trm == "12" and r.intr_rate == 3.0


def test_collect_job_writes_records_and_counts(spark, scratch):
    land_root = os.path.join(scratch, "land")
    landing_fixture(land_root)
    out = os.path.join(scratch, "out")
    counts = collect.collect_job(spark, land_root, out, "20250714_175227")
    assert {(r.prdt_div, r.records, r.reported, r.snapshot_ts) for r in counts.collect()} == {
        ("D", 3, 2, "20250714_175227"), ("S", 1, 1, "20250714_175227")}
    recs = spark.read.parquet(os.path.join(out, "records"))
    assert recs.count() == 4 and {"prdt_div", "snapshot_ts", "rec"} <= set(recs.columns)
    # a second landing of the same division: the newest snapshot wins per division
    collect.collect_job(spark, land_root, out, "20250801_000000")
    recs = spark.read.parquet(os.path.join(out, "records"))
    newest = files.latest_per_group(recs, ["prdt_div"], "snapshot_ts")
    assert {r.snapshot_ts for r in newest.collect()} == {"20250801_000000"}
    assert newest.count() == 4


def test_cluster_conf_sizes_shuffles():
    from prodsearch.session import cluster_conf
    small = cluster_conf(10 * 2**30, 64)
    assert int(small["spark.sql.shuffle.partitions"]) == 192  # 3 per core floor
    big = cluster_conf(100 * 2**40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 819_200


def test_prompts_carry_raw_data(spark):
    products = spark.createDataFrame(
        [(1, "deposit", "은행A", "예금1", [1.0, 0.0])],
        "product_id long, product_type string, company string, product_name string, "
        "embedding array<float>").withColumn("raw_data", F.create_map(F.lit("intr_rate"),
                                                                      F.lit("3.5")))
    queries = spark.createDataFrame([(10, 1, "예금 추천해줘", [1.0, 0.0])],
                                    "query_id long, conv_id long, text string, "
                                    "embedding array<double>")
    p = recommend.recommend(products, queries, materialize=False)["prompts"].first()
    assert '"intr_rate":"3.5"' in p.prompt and "예금1" in p.prompt


def test_position_follows_file_order_across_files(spark, tmp_path):
    """Spark packs the larger file first; keep-first must still follow file
    order (a.csv before b.csv), then row order inside each file."""
    from prodsearch.operators import clean
    from prodsearch.plans import preprocess
    from prodsearch.sources import files as FS
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.csv").write_text("k,v\nx,a1\ny,a2\nx,a3\n", encoding="utf-8")
    (d / "b.csv").write_text("k,v\n" + "".join(f"z{i},b{i}\n" for i in range(500))
                             + "x,b-late\ny,b-late\n", encoding="utf-8")
    df = preprocess.with_position(FS.read_raw_csv(spark, str(d)))
    got = {r.k: r.v for r in clean.keep_first(df, ["k"], [preprocess.POSITION]).collect()}
    assert got["x"] == "a1" and got["y"] == "a2" and got["z3"] == "b3"
    plain = spark.createDataFrame([("x", "p1"), ("x", "p2")], "k string, v string")
    assert preprocess.with_position(plain).schema[preprocess.POSITION].dataType.simpleString() \
        == "bigint"


def test_pack_pages_shuffles_records_once(spark):
    """Records cross one exchange, on (key, page), which the page aggregate
    reuses (no spread before it, no second exchange after it)."""
    import io
    from contextlib import redirect_stdout
    base = spark.createDataFrame([(k, f"b{k}") for k in range(20)], "k long, bv string")
    opt = spark.createDataFrame([(k % 20, i, float(i)) for k, i in zip(range(400), range(400))],
                                "k long, n long, x double")
    env = pages.pack_pages(base, opt, "k", division="D", page_size=7)
    buf = io.StringIO()
    with redirect_stdout(buf):
        env.explain()
    record_shuffles = [ln for ln in buf.getvalue().splitlines()
                       if "Exchange hashpartitioning" in ln and "pageNo" in ln]
    assert len(record_shuffles) == 1, record_shuffles
    spread = [ln for ln in buf.getvalue().splitlines()
              if "Exchange hashpartitioning(xxhash64" in ln]
    assert not spread, spread
    # every key has 20 option rows -> ceil(20 / 7) = 3 pages each at most
    pages_per_key = {r.k: r.n for r in env.groupBy("k").count().withColumnRenamed(
        "count", "n").collect()}
    assert set(pages_per_key) == set(range(20)) and max(pages_per_key.values()) <= 3


def test_checkpoint_folder_must_be_shared_on_a_cluster(spark, monkeypatch):
    import pytest
    from prodsearch import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def _envelope(api, no, last, base, options):
    return (api, "020000", no, json.dumps({"result": {
        "total_count": 1, "max_page_no": last, "now_page_no": no, "prdt_div": "D",
        "baseList": base, "optionList": options}}))


def test_merge_learns_of_a_group_from_its_pages_in_few_shuffles(spark):
    """names on both sides and groups without base records are known
    from the pages, before their records are rows."""
    k = S.PRODUCT_KEY
    landed = [_envelope("A1", 1, 2, [{k: "1", "x": "b", "z": "0"}, {k: "2", "x": "c"}], []),
              _envelope("A1", 2, 2, [], [{k: "1", "x": "o", "y": "1"}, {k: "1", "y": "2"}, {k: "9", "y": "3"}]),
              _envelope("B2", 1, 1, [], [{k: "5", "x": "p"}, {"y": "4"}]),
              _envelope("C3", 1, 2, [{k: "7", "x": "q"}], [{k: "7", "x": "r"}])]     # page 2 is missing
    df = spark.createDataFrame(landed, "api string, region_code string, pageNo long, j string")
    df = pages.parse_pages(df, "j").drop("j")
    for hot in (None, 1, 1_000_000):
        out = collect.merge_records(df, hot_rows=hot)
        got = sorted((r.api, sorted(r.rec.items())) for r in out.collect())
        assert got == sorted((a, sorted(r.items())) for a, r in [
            ("A1", {k: "1", "x_x": "b", "z": "0", "x_y": "o", "y": "1"}), ("A1", {k: "1", "x_x": "b", "z": "0", "y": "2"}),
            ("A1", {k: "2", "x_x": "c"}), ("B2", {k: "5", "x": "p"}), ("B2", {"y": "4"})])
    plan = collect.merge_records(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 20         # 26 when names and groups came from the rows
    good = pages.complete_groups(df)
    assert {(r.api, r.pages_ok, r.pages_bad) for r in good.collect()} == {("A1", 2, 0), ("B2", 1, 0)}
    counts = collect.record_counts(collect.merge_records(df), df).collect()
    assert [(r.prdt_div, r.records, r.reported) for r in counts] == [("D", 5, 2)]
