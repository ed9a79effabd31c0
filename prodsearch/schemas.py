"""Schemas, code lists and other fixed values of the product catalogue.

The values in the FIXED VALUES block must equal the ones the original
catalogue pipeline uses (codes sent by the disclosure API, Korean labels
shown to users, markers searched in answers); results depend on them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original pipeline exactly; do not edit)
# ---------------------------------------------------------------------------

# Sector ("region") codes of the disclosure API and their names.
REGION_CODES = {
    "020000": "은행",
    "030200": "여신전문금융업",
    "030300": "저축은행",
    "050000": "보험회사",
    "060000": "금융투자업",
}

# Product type -> label shown to users.
PRODUCT_TYPE_LABELS = {
    "deposit": "정기예금",
    "saving": "적금",
    "annuity": "연금저축",
    "mortgage": "주택담보대출",
    "rent": "전세자금대출",
    "credit": "개인신용대출",
}

# Product division letter (file name prefix) -> product type.
DIVISION_TYPES = {
    "D": "deposit",
    "S": "saving",
    "P": "annuity",
    "M": "mortgage",
    "R": "rent",
    "C": "credit",
}

# Division "F" (companies) joins on the company code, all others on the
# product code.
COMPANY_DIVISION = "F"
COMPANY_KEY = "fin_co_no"
PRODUCT_KEY = "fin_prdt_cd"

# Core columns per product type, in this order.
CORE_COLUMNS = {
    "deposit": ["kor_co_nm", "fin_prdt_nm", "join_way", "mtrt_int", "spcl_cnd",
                "join_deny", "join_member", "etc_note", "max_limit", "save_trm",
                "intr_rate", "intr_rate2"],
    "saving": ["kor_co_nm", "fin_prdt_nm", "join_way", "mtrt_int", "spcl_cnd",
               "join_deny", "join_member", "etc_note", "max_limit", "rsrv_type_nm",
               "save_trm", "intr_rate", "intr_rate2"],
    "annuity": ["kor_co_nm", "fin_prdt_nm", "join_way", "pnsn_kind_nm", "prdt_type_nm",
                "dcls_rate", "guar_rate", "btrm_prft_rate_1", "btrm_prft_rate_2",
                "btrm_prft_rate_3", "etc", "pnsn_recp_trm_nm", "pnsn_entr_age_nm",
                "mon_paym_atm_nm", "paym_prd_nm", "pnsn_strt_age_nm"],
    "mortgage": ["kor_co_nm", "fin_prdt_nm", "join_way", "loan_inci_expn", "erly_rpay_fee",
                 "dly_rate", "loan_lmt", "mrtg_type_nm", "rpay_type_nm", "lend_rate_type_nm",
                 "lend_rate_min", "lend_rate_max", "lend_rate_avg"],
    "rent": ["kor_co_nm", "fin_prdt_nm", "join_way", "loan_inci_expn", "erly_rpay_fee",
             "dly_rate", "loan_lmt", "rpay_type_nm", "lend_rate_type_nm", "lend_rate_min",
             "lend_rate_max", "lend_rate_avg"],
    "credit": ["kor_co_nm", "fin_prdt_nm", "join_way", "crdt_prdt_type_nm",
               "crdt_lend_rate_type_nm", "crdt_grad_1", "crdt_grad_4", "crdt_grad_5",
               "crdt_grad_6", "crdt_grad_10", "crdt_grad_11", "crdt_grad_avg"],
}

# Essential columns and dedup key of every product type.
COMPANY_COL = "kor_co_nm"
PRODUCT_COL = "fin_prdt_nm"
ESSENTIAL_COLUMNS = [COMPANY_COL, PRODUCT_COL]

# Search-text templates: (label, column, unit suffix). A (label, None, "")
# entry is a heading line without a value.
SEARCH_TEXT_SPECS = {
    "deposit": [
        ("상품명", "fin_prdt_nm", ""), ("금융회사", "kor_co_nm", ""),
        ("기본금리", "intr_rate", "%"), ("최고금리", "intr_rate2", "%"),
        ("저축기간", "save_trm", "개월"), ("최고한도", "max_limit", ""),
        ("우대조건", "spcl_cnd", ""), ("가입제한", "join_deny", ""),
        ("가입대상", "join_member", ""), ("가입방법", "join_way", ""),
    ],
    "saving": [
        ("상품명", "fin_prdt_nm", ""), ("금융회사", "kor_co_nm", ""),
        ("기본금리", "intr_rate", "%"), ("최고금리", "intr_rate2", "%"),
        ("저축기간", "save_trm", "개월"), ("적립유형", "rsrv_type_nm", ""),
        ("최고한도", "max_limit", ""), ("우대조건", "spcl_cnd", ""),
        ("가입제한", "join_deny", ""), ("가입대상", "join_member", ""),
        ("가입방법", "join_way", ""),
    ],
    "annuity": [
        ("상품명", "fin_prdt_nm", ""), ("금융회사", "kor_co_nm", ""),
        ("연금종류", "pnsn_kind_nm", ""), ("상품유형", "prdt_type_nm", ""),
        ("공시이율", "dcls_rate", "%"), ("최저보증이율", "guar_rate", "%"),
        ("과거수익률1년", "btrm_prft_rate_1", "%"), ("과거수익률2년", "btrm_prft_rate_2", "%"),
        ("과거수익률3년", "btrm_prft_rate_3", "%"), ("연금수령기간", "pnsn_recp_trm_nm", ""),
        ("가입연령", "pnsn_entr_age_nm", ""), ("월납입금액", "mon_paym_atm_nm", ""),
        ("납입기간", "paym_prd_nm", ""), ("연금개시연령", "pnsn_strt_age_nm", ""),
        ("가입방법", "join_way", ""),
    ],
    "mortgage": [
        ("상품명", "fin_prdt_nm", ""), ("금융회사", "kor_co_nm", ""),
        ("담보유형", "mrtg_type_nm", ""), ("상환방식", "rpay_type_nm", ""),
        ("금리유형", "lend_rate_type_nm", ""), ("최저금리", "lend_rate_min", "%"),
        ("최고금리", "lend_rate_max", "%"), ("평균금리", "lend_rate_avg", "%"),
        ("대출한도", "loan_lmt", ""), ("가입방법", "join_way", ""),
        ("부대비용", "loan_inci_expn", ""), ("중도상환수수료", "erly_rpay_fee", ""),
        ("연체금리", "dly_rate", ""),
    ],
    "rent": [
        ("상품명", "fin_prdt_nm", ""), ("금융회사", "kor_co_nm", ""),
        ("상환방식", "rpay_type_nm", ""), ("금리유형", "lend_rate_type_nm", ""),
        ("최저금리", "lend_rate_min", "%"), ("최고금리", "lend_rate_max", "%"),
        ("평균금리", "lend_rate_avg", "%"), ("대출한도", "loan_lmt", ""),
        ("가입방법", "join_way", ""), ("부대비용", "loan_inci_expn", ""),
        ("중도상환수수료", "erly_rpay_fee", ""),
    ],
    "credit": [
        ("상품명", "fin_prdt_nm", ""), ("금융회사", "kor_co_nm", ""),
        ("대출유형", "crdt_prdt_type_nm", ""), ("금리유형", "crdt_lend_rate_type_nm", ""),
        ("신용등급별금리", None, ""),
        ("- 900점초과", "crdt_grad_1", "%"), ("- 801-900점", "crdt_grad_4", "%"),
        ("- 701-800점", "crdt_grad_5", "%"), ("- 601-700점", "crdt_grad_6", "%"),
        ("- 501-600점", "crdt_grad_10", "%"), ("- 401-500점", "crdt_grad_11", "%"),
        ("평균금리", "crdt_grad_avg", "%"), ("가입방법", "join_way", ""),
    ],
}
# Types without a template: "상품명: <name>, 금융회사: <company>".
SEARCH_TEXT_OTHER = [("상품명", "fin_prdt_nm"), ("금융회사", "kor_co_nm")]
MISSING_TEXT = "N/A"

# Category phrase -> product type, first matching rule wins.
# Rule kinds: ("contains", s), ("equals", s), ("contains_not", s, t) means
# contains s and does not contain t, ("contains_any", [s, ...]).
CATEGORY_RULES_LITERAL = [
    ("contains", "정기예금", "deposit"),
    ("contains", "적금", "saving"),
    ("equals", "예금", "deposit"),
    ("contains_not", ("저축", "적금"), "deposit"),
    ("contains", "연금", "annuity"),
    ("contains", "주택담보", "mortgage"),
    ("contains", "전세", "rent"),
    ("contains_any", ("신용대출", "개인신용"), "credit"),
]

# Keyword taxonomy used to classify a question's product category.
CATEGORY_TAXONOMY = [
    ("정기예금", ["정기예금", "예금", "목돈 불리기", "일시불 예치", "저축예금", "정액예치"]),
    ("적금", ["적금", "매월 저축", "목돈 모으기", "분할 납입", "정기적금", "월납적금"]),
    ("연금저축", ["연금", "노후 준비", "은퇴 자금", "연금저축", "개인연금", "퇴직연금"]),
    ("주택담보대출", ["주택담보대출", "아파트담보대출", "부동산담보대출", "주택구입자금", "주택담보"]),
    ("전세자금대출", ["전세자금대출", "전세대출", "전세보증금", "주거자금", "임차보증금"]),
    ("개인신용대출", ["개인신용대출", "신용대출", "무담보대출", "마이너스통장", "직장인신용대출"]),
]

# Intent taxonomy (recommendation, information, comparison, clarification).
INTENT_TAXONOMY = [
    ("recommendation", ["추천해줘", "좋은 상품", "어떤 게 나을까"]),
    ("information", ["설명해줘", "알려줘", "뭐였는데", "정보"]),
    ("comparison", ["비교", "차이점", "어떤 게 더"]),
    ("clarification", ["아까", "전에", "마지막으로"]),
]

# Answer routing keywords.
INFORMATION_KEYWORDS = ["설명", "정보", "뭐였는데", "알려줘", "마지막으로"]
COMPARISON_KEYWORDS = ["비교"]
DEFAULT_INTENT = "information"

# Markers in assistant answers.
PRODUCT_MARKER = "📍 추천 상품:"
COMPANY_MARKER = "📍 금융회사:"

# Fixed messages.
NO_RESULTS_MESSAGE = "검색된 상품이 없습니다. 다른 조건으로 검색해보세요."
GENERATION_ERROR_MESSAGE = "추천 생성 중 오류가 발생했습니다."
SYSTEM_ERROR_MESSAGE = "시스템 오류가 발생했습니다. 다시 시도해주세요."
CONTEXT_NOTE_PREFIX = "이전 추천 상품 정보: "

# Defaults for absent fields of a search result.
UNKNOWN_TEXT = "정보 없음"
OTHER_TYPE = "기타"

# Sizes.
RETRIEVE_K = 3
HISTORY_CAP = 20
MAX_CONVERSATION_TURNS = 10
OVERFLOW_KEEP_RATIO = 0.7
CONTEXT_WINDOW = 6
CONTEXT_NOTE_CHARS = 200
RAW_RESPONSE_CHARS = 50
SCORE_DIGITS = 3

# Amount and period units.
AMOUNT_UNITS = {"억": 100_000_000, "만": 10_000}
PERIOD_UNITS = {"년": 12, "개월": 1}

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

RECORD = T.MapType(T.StringType(), T.StringType())

PAGE_SCHEMA = T.StructType([
    T.StructField("result", T.StructType([
        T.StructField("total_count", T.LongType()),
        T.StructField("max_page_no", T.LongType()),
        T.StructField("now_page_no", T.LongType()),
        T.StructField("prdt_div", T.StringType()),
        T.StructField("baseList", T.ArrayType(RECORD)),
        T.StructField("optionList", T.ArrayType(RECORD)),
    ])),
])

ANALYSIS_SCHEMA = T.StructType([
    T.StructField("product_category", T.StringType()),
    T.StructField("user_intent", T.StringType()),
    T.StructField("requires_recommendation_format", T.BooleanType()),
    T.StructField("key_requirements", T.ArrayType(T.StringType())),
    T.StructField("user_profile", T.StringType()),
    T.StructField("urgency", T.StringType()),
    T.StructField("amount_mentioned", T.StringType()),
    T.StructField("period_mentioned", T.StringType()),
])


def product_schema(product_type: str) -> T.StructType:
    """All-string schema of a raw product file (types are applied later)."""
    cols = list(CORE_COLUMNS[product_type])
    for extra in ("dcls_month", "fin_co_no", "fin_prdt_cd", "region_code", "region_name"):
        if extra not in cols:
            cols.append(extra)
    return T.StructType([T.StructField(c, T.StringType()) for c in cols])


def numeric_columns(product_type: str, compat: bool = False) -> list[str]:
    """Columns coerced to double.

    Default: the rate/grade columns that hold numbers. ``compat`` uses the
    original substring rule ('rate' or 'grad' in the name), which also hits
    text columns such as ``lend_rate_type_nm`` and ``dly_rate``.
    """
    cols = CORE_COLUMNS[product_type]
    if compat:
        return [c for c in cols if "rate" in c or "grad" in c]
    text_like = {"lend_rate_type_nm", "crdt_lend_rate_type_nm", "dly_rate"}
    return [c for c in cols if ("rate" in c or "grad" in c) and c not in text_like]
