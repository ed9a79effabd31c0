"""Quirk decisions and empty inputs (FIXTURES section 3)."""

import json
import os

from pyspark.sql import functions as F

from prodsearch import schemas as S
from prodsearch.functions import text as TX
from prodsearch.operators import clean, dialog, joins, retrieve, stats
from prodsearch.plans import collect, preprocess, recommend
from prodsearch.sources import files


def test_blank_key_survives_drop_but_fails_validation(spark):
    df = spark.createDataFrame([("   ", "p"), ("c", "q")], "kor_co_nm string, fin_prdt_nm string")
    kept = clean.drop_missing(df, S.ESSENTIAL_COLUMNS)
    assert kept.count() == 2  # blank is not missing at the drop step
    assert [r.fin_prdt_nm for r in clean.required_fields(kept, S.ESSENTIAL_COLUMNS).collect()] \
        == ["q"]


def test_company_division_joins_on_company_code(spark, scratch):
    d = os.path.join(scratch, "api=company", "region_code=020000", "pageNo=1")
    os.makedirs(d)
    res = {"total_count": 1, "max_page_no": 1, "now_page_no": 1, "prdt_div": "F",
           "baseList": [{"fin_co_no": "c1", "kor_co_nm": "은행"}],
           "optionList": [{"fin_co_no": "c1", "area_nm": "서울"},
                          {"fin_co_no": "c1", "area_nm": "부산"}]}
    with open(os.path.join(d, "p.json"), "w", encoding="utf-8") as f:
        json.dump({"result": res}, f, ensure_ascii=False)
    recs, counts, _ = collect.collect_landing(spark, scratch, "20250101_000000")
    got = sorted(r.rec["area_nm"] for r in recs.collect())
    assert got == ["부산", "서울"]
    assert counts.first().prdt_div == "F"


def test_operators_on_zero_rows(spark):
    msgs = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    part = spark.createDataFrame([], "kor_co_nm string, fin_prdt_nm string, intr_rate string")
    vec = spark.createDataFrame([], "product_id long, embedding array<float>, label int")
    q = spark.createDataFrame([], "query_id long, embedding array<double>")
    frames = [
        dialog.last_n(msgs, 3), dialog.overflow_trim(msgs), dialog.overflow_counts(msgs),
        dialog.last_recommended(msgs), dialog.context_note(msgs, "x"),
        dialog.append_turns(msgs, spark.createDataFrame(
            [], "conv_id long, question string, answer string")),
        stats.turn_counts(msgs), stats.type_distribution(msgs, "role"),
        stats.range_stats(part.withColumn("x", F.lit(1.0)), ["kor_co_nm"], ["x"]),
        preprocess.preprocess_product(part, "deposit"),
        clean.keep_first(part, ["kor_co_nm"], ["fin_prdt_nm"]),
        retrieve.vector_topk(vec, q, 3), retrieve.vector_topk(vec, q, 3, payload=["label"]),
        joins.option_only_fallback(part, part, ["kor_co_nm"], ["fin_prdt_nm"]),
        files.latest_per_group(part, ["kor_co_nm"], "fin_prdt_nm"),
        recommend.analysis_from_json(msgs, "text"),
        msgs.select(TX.marker_value("text", TX.marker_regex(S.PRODUCT_MARKER))),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)
    # global aggregates answer with one row of zeros
    audit = stats.step_audit(part, F.lit(True), ["kor_co_nm"]).collect()
    assert [tuple(r) for r in audit] == [(0, 0, 0)]
    assert stats.collection_summary(msgs, "role").first().n_records == 0
