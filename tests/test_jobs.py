"""The whole jobs: six raw files -> processed, statistics, audit -> index -> answers."""

import os

from prodsearch import schemas as S
from prodsearch.plans import preprocess, recommend

# Search texts of one product per type, every text cell "<column>*" and every rate 1.5.
TEXTS = {
    "deposit": """상품명: P1
금융회사: C1
기본금리: 1.5%
최고금리: 1.5%
저축기간: save_trm*개월
최고한도: max_limit*
우대조건: spcl_cnd*
가입제한: join_deny*
가입대상: join_member*
가입방법: join_way*""",
    "saving": """상품명: P1
금융회사: C1
기본금리: 1.5%
최고금리: 1.5%
저축기간: save_trm*개월
적립유형: rsrv_type_nm*
최고한도: max_limit*
우대조건: spcl_cnd*
가입제한: join_deny*
가입대상: join_member*
가입방법: join_way*""",
    "annuity": """상품명: P1
금융회사: C1
연금종류: pnsn_kind_nm*
상품유형: prdt_type_nm*
공시이율: 1.5%
최저보증이율: 1.5%
과거수익률1년: 1.5%
과거수익률2년: 1.5%
과거수익률3년: 1.5%
연금수령기간: pnsn_recp_trm_nm*
가입연령: pnsn_entr_age_nm*
월납입금액: mon_paym_atm_nm*
납입기간: paym_prd_nm*
연금개시연령: pnsn_strt_age_nm*
가입방법: join_way*""",
    "mortgage": """상품명: P1
금융회사: C1
담보유형: mrtg_type_nm*
상환방식: rpay_type_nm*
금리유형: lend_rate_type_nm*
최저금리: 1.5%
최고금리: 1.5%
평균금리: 1.5%
대출한도: loan_lmt*
가입방법: join_way*
부대비용: loan_inci_expn*
중도상환수수료: erly_rpay_fee*
연체금리: dly_rate*""",
    "rent": """상품명: P1
금융회사: C1
상환방식: rpay_type_nm*
금리유형: lend_rate_type_nm*
최저금리: 1.5%
최고금리: 1.5%
평균금리: 1.5%
대출한도: loan_lmt*
가입방법: join_way*
부대비용: loan_inci_expn*
중도상환수수료: erly_rpay_fee*""",
    "credit": """상품명: P1
금융회사: C1
대출유형: crdt_prdt_type_nm*
금리유형: crdt_lend_rate_type_nm*
신용등급별금리:
- 900점초과: 1.5%
- 801-900점: 1.5%
- 701-800점: 1.5%
- 601-700점: 1.5%
- 501-600점: 1.5%
- 401-500점: 1.5%
평균금리: 1.5%
가입방법: join_way*""",
}


def raw_file(root, product_type, stamp, name):
    letter = {v: k for k, v in S.DIVISION_TYPES.items()}[product_type]
    cols = S.CORE_COLUMNS[product_type]
    rates = set(S.numeric_columns(product_type))

    def row(product, company):
        return ",".join(product if c == "fin_prdt_nm" else company if c == "kor_co_nm" else
                        "1.5" if c in rates else f"{c}*" for c in cols)

    with open(os.path.join(root, f"{letter}_{stamp}.csv"), "w", encoding="utf-8-sig") as f:
        f.write("\n".join([",".join(cols), row(name, "C1 "), row(name, "C1"), row("Q2", "")]) + "\n")


def test_preprocess_all_then_index_and_answer(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    os.makedirs(raw)
    for t in S.CORE_COLUMNS:
        raw_file(raw, t, "20250101_000000", "OLD")
        raw_file(raw, t, "20250714_175227", "P1")
    status = {r.product_type: (r.status, r.rows) for r in
              preprocess.preprocess_all(spark, raw, out, "2025-07-14").collect()}
    assert status == {t: ("ok", 1) for t in S.CORE_COLUMNS}
    for t, text in TEXTS.items():
        r = spark.read.parquet(f"{out}/processed/product_type={t}").first()
        assert r.search_text == text, t
    audit = {r.product_type: (r.n_in, r.n_after_drop, r.n_after_dedup)
             for r in spark.read.parquet(f"{out}/audit").collect()}
    assert audit == {t: (3, 2, 1) for t in S.CORE_COLUMNS}
    counts = spark.read.parquet(f"{out}/counts").collect()
    assert {(r.product_type, r.n_products) for r in counts} == {(t, 1) for t in S.CORE_COLUMNS}

    model, products = recommend.index_products(spark, f"{out}/processed", dim=64)
    asked = spark.createDataFrame([(1, 7, "연금저축 P1 추천해줘")], "query_id long, conv_id long, text string")
    answers = spark.createDataFrame([(1, "P1 is it", "")], "query_id long, generated string, fallback string")
    res = recommend.answer(model, products, asked, answers=answers, k=6)
    assert {r.product_type for r in res["results"].collect()} == {"annuity"}
    assert res["responses"].first().recommendation == "P1 is it"


def test_preprocess_all_skips_and_isolates(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    os.makedirs(raw)
    raw_file(raw, "saving", "20250714_175227", "P1")
    with open(os.path.join(raw, "D_20250714_175227.csv"), "w") as f:
        f.write("x,y\n1,2\n")
    status = {r.product_type: r.status for r in preprocess.preprocess_all(spark, raw, out, "t").collect()}
    assert status == {**dict.fromkeys(S.CORE_COLUMNS, "missing"), "saving": "ok", "deposit": "failed"}
