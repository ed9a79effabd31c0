"""Scalar and text functions (F1-F19) on hand-made rows."""

from pyspark.sql import functions as F

from prodsearch import schemas as S
from prodsearch.functions import text as TX


def one_col(spark, values, name="v", dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {dtype}")


def one_col_double(spark, vals):
    return spark.createDataFrame([(float(v),) for v in vals], "v double").coalesce(1)


def test_strip_unicode(spark):
    df = one_col(spark, ["　가나은행\t", "  a b  ", None])
    got = [r[0] for r in df.select(TX.strip("v")).collect()]
    assert got == ["가나은행", "a b", None]


def test_strip_matches_python_whitespace(spark):
    """Every character Python's str.strip() removes, including U+001C..U+001F,
    which Java's Unicode \\s does not cover; inner spaces stay."""
    vals = [c + "a" + c + "b" + c for c in map(chr, range(0x3001)) if c.isspace()]
    got = [r[0] for r in one_col(spark, vals).select(TX.strip("v")).collect()]
    assert got == [v.strip() for v in vals]


def test_to_number_like_pandas(spark):
    vals = ["3.5", " 3.5 ", "3.5%", "1,000", "1.5d", "nan", "", None, "-2", "1e3", ".5"]
    got = [r[0] for r in one_col(spark, vals).select(TX.to_number("v")).collect()]
    assert got == [3.5, 3.5, None, None, None, None, None, None, -2.0, 1000.0, 0.5]


def test_to_number_against_pandas(spark):
    """Same values as pandas.to_numeric(errors='coerce') (NaN read as null),
    including infinity literals, overflow and underflow. Not covered: long
    digit strings, where pandas' fast parser can be one ulp off."""
    import math

    import pandas as pd
    vals = ["inf", "-inf", "+inf", "INF", "iNf", "infinity", "-Infinity", "infinit", "infs",
            " inf", "inf ", "nan", "-nan", "1e308", "1.8e308", "-1e400", "1e-400", "+.5e1",
            " +5 ", "5e", "00.", ".", "+", "-", "\x0b7\x0c", "1_000", "0x10", "１２", "3\xa0",
            "1,000", "12abc", "", " ", "None"]
    want = [None if isinstance(x, float) and math.isnan(x) else float(x)
            for x in pd.to_numeric(pd.Series(vals, dtype=object), errors="coerce").tolist()]
    got = [r[0] for r in one_col(spark, vals).select(TX.to_number("v")).collect()]
    assert got == want


def test_fixed_matches_python_format(spark):
    """'%.Nf' as Python prints it: exact binary value, ties to even."""
    import random
    import struct
    random.seed(3)
    vals = [2.675, 0.125, 0.375, 1.005, 0.015, -2.675, -0.0, -0.001, 2.5, 99.995, 8.125,
            float("nan"), float("inf"), float("-inf"), 5e-324, 4503599627370.495]
    vals += [k / 8 for k in range(-40, 40)] + [k / 1000 for k in range(0, 3000, 5)]
    vals += [struct.unpack("d", struct.pack("Q", random.getrandbits(64)))[0] for _ in range(300)]
    vals = [v for v in vals if not abs(v) >= 2.0 ** 52 / 1e4 or v != v or abs(v) == float("inf")]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "i long, x double")
    for d in (0, 1, 2, 4):
        got = dict(df.select("i", TX.fixed("x", d)).collect())
        assert [got[i] for i in range(len(vals))] == ["%.*f" % (d, v) for v in vals]
    assert df.select(TX.pct("x")).first()[0] == "2.67%"
    rounded = dict(df.select("i", TX.py_round("x", 3)).collect())
    want = [round(v, 3) for v in vals]
    assert all(rounded[i] == w or (w != w and rounded[i] != rounded[i])
               for i, w in enumerate(want))


def test_number_text_matches_python_str(spark):
    """str(float) layout: fixed notation for exponents -4..15, else 1e+16."""
    import random
    random.seed(5)
    vals = [0.00064, 1e-4, 1.5e-5, 0.1 + 0.2, 12345678.9, 1e7, 10000000.0, 1e15 + 0.3, 1e16,
            1.5e16, 1e22, 0.0, -0.0, -1.5, 2.5e-300, 1.7976931348623157e308, 123.0, 100.5,
            float("nan"), float("inf"), float("-inf")]
    vals += [10 ** random.uniform(-6, 16) * random.choice([1, -1]) for _ in range(500)]
    vals += [round(random.uniform(0, 100), random.randint(0, 5)) for _ in range(300)]
    got = [r[0] for r in one_col_double(spark, vals).select(TX.py_number_text("v")).collect()]
    assert got == [str(v) for v in vals]


def test_blank_flags(spark):
    df = one_col(spark, [None, "   ", " x "])
    got = df.select(TX.is_available("v"), TX.blank_clean("v")).collect()
    assert [tuple(r) for r in got] == [(False, ""), (False, ""), (True, "x")]


def test_search_text_null_and_compat(spark):
    df = spark.createDataFrame([("예금A", "은행A", None, 10000000.0)],
                               "fin_prdt_nm string, kor_co_nm string, intr_rate double, "
                               "max_limit double")
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    spec = [("상품명", "fin_prdt_nm", ""), ("기본금리", "intr_rate", "%"),
            ("최고한도", "max_limit", ""), ("가입방법", "join_way", "")]
    default = df.select(TX.search_text(types, spec)).first()[0]
    compat = df.select(TX.search_text(types, spec, null_text="nan")).first()[0]
    assert default == "상품명: 예금A\n기본금리: N/A%\n최고한도: 10000000.0\n가입방법: N/A"
    assert compat.split("\n")[1] == "기본금리: nan%"
    assert "E" not in default  # no exponent for large limits


def test_search_text_other(spark):
    df = spark.createDataFrame([("p", "c")], "fin_prdt_nm string, kor_co_nm string")
    assert df.select(TX.search_text_other("fin_prdt_nm", "kor_co_nm")).first()[0] == \
        "상품명: p, 금융회사: c"


def test_marker_value_plain_and_bold(spark):
    texts = ["앞\n📍 **추천 상품**: 상품X\n📍 **금융회사**: 은행Y",
             "📍 추천 상품: 상품X 📍 추천 상품: 둘째\n📍 금융회사: 은행Y",
             "no marker"]
    df = one_col(spark, texts)
    pre = TX.marker_regex(S.PRODUCT_MARKER)
    cre = TX.marker_regex(S.COMPANY_MARKER)
    got = df.select(TX.marker_value("v", pre), TX.marker_value("v", cre)).collect()
    assert [tuple(r) for r in got] == [("상품X", "은행Y"), ("상품X", "은행Y"), (None, None)]
    strict = TX.marker_regex(S.PRODUCT_MARKER, allow_bold=False)
    assert df.select(TX.marker_value("v", strict)).collect()[0][0] is None


def test_amounts_and_periods(spark):
    df = one_col(spark, ["3000만원을 2년간", "7억원", "1억 5000만원 18개월", "원금", None])
    got = df.select(TX.amount_won("v"), TX.period_months("v")).collect()
    assert [tuple(r) for r in got] == [(30000000, 24), (700000000, None),
                                        (150000000, 18), (None, None), (None, None)]


def test_amount_forms(spark):
    """Separators, decimals, inner units, and numbers that do not fit."""
    want = {"1,000만원": 10_000_000, "1.5억원": 150_000_000, "3천만원": 30_000_000, "5백만원": 5_000_000,
            "1억 2천만 원": 120_000_000, "2천5백만원": 25_000_000, "10,000원": 10_000, "2천원": 2_000,
            "1억 2,500만 3천원": 125_003_000, "0.5만원": 5_000, "50억원": 5_000_000_000,
            "123456789012억원": None, "99999999999999999999999999원": None, "원": None, "천원": None}
    got = dict(zip(want, (r[0] for r in one_col(spark, list(want)).select(TX.amount_won("v")).collect())))
    assert got == want
    months = [r[0] for r in one_col(spark, ["999999999년", "12개월", "3 년"]).select(
        TX.period_months("v")).collect()]
    assert months == [None, 12, 36]


def test_every_amount_and_period(spark):
    want = {"월 30만원씩 2년 6개월, 만기 1억 2천만원": ([300_000, 120_000_000], [30]),
            "1년 반 동안 500원": ([500], [18]), "1.5년 또는 6달": ([], [18, 6]), "반년만": ([], [6]),
            "2024년 3월에 1,000만원": ([10_000_000], []), "3년간 10원 20원": ([10, 20], [36]),
            "1년 반복, 12개월 혹은 24 개월": ([], [12, 12, 24]), "2년반짜리": ([], [30]), "": ([], []),
            "123456789012억원 5원": ([None, 5], []), "99999999999999999999개월 1년": ([], [None, 12])}
    rows = one_col(spark, list(want)).select(TX.amounts_won("v"), TX.periods_months("v"), TX.amount_won("v"),
                                             TX.period_months("v")).collect()
    for text, r in zip(want, rows):
        won, months = want[text]
        assert (r[0], r[1]) == (won, months), text
        assert (r[2], r[3]) == (won[0] if won else None, months[0] if months else None), text
    assert one_col(spark, [None]).select(TX.amounts_won("v"), TX.period_months("v")).first()[:] == (None, None)


def test_category_rules_default_and_compat(spark):
    phrases = ["연금저축", "정기예금", "적금", "예금", "주택담보대출", "전세자금대출",
               "개인신용대출", "보험", ""]
    df = one_col(spark, phrases)
    d = [r[0] for r in df.select(TX.category_to_type("v", TX.category_rules())).collect()]
    c = [r[0] for r in df.select(TX.category_to_type("v", TX.category_rules(True))).collect()]
    assert d == ["annuity", "deposit", "saving", "deposit", "mortgage", "rent", "credit", "", ""]
    assert c[0] == "deposit" and c[1:] == d[1:]
    # only '연금저축' changes: phrases an earlier rule catches keep their type
    mixed = one_col(spark, ["정기예금 연금", "적금 연금", "연금 예금", "노후 연금"])
    for compat in (False, True):
        m = [r[0] for r in mixed.select(TX.category_to_type("v", TX.category_rules(compat)))
             .collect()]
        assert m == ["deposit", "saving", "annuity", "annuity"]


def test_route_intent(spark):
    df = spark.createDataFrame([(None, "아무 질문"), ("comparison", "x"), ("recommendation", "비교해줘"),
                                ("recommendation", "알려줘 정보"), ("recommendation", "추천")],
                               "intent string, q string")
    got = [r[0] for r in df.select(TX.route_intent("intent", "q")).collect()]
    assert got == ["information", "comparison", "comparison", "information", "recommendation"]


def test_classify_by_keywords_ties_to_first(spark):
    tax = [("a", ["x", "y"]), ("b", ["z", "w"])]
    df = one_col(spark, ["x z", "z w x", "nothing", None])
    got = [r[0] for r in df.select(TX.classify_by_keywords("v", tax)).collect()]
    assert got == ["a", "b", "", ""]


def test_taxonomy_on_examples(spark):
    df = one_col(spark, ["3000만원을 2년간 안전하게 운용할 수 있는 정기예금 추천해주세요",
                         "40대 직장인이 노후 준비를 위해 연금저축 추천해주세요",
                         "생활자금 마련을 위해 1000만원 개인신용대출"])
    got = [r[0] for r in df.select(TX.classify_by_keywords("v", S.CATEGORY_TAXONOMY,
                                                           lower=False)).collect()]
    assert got == ["정기예금", "연금저축", "개인신용대출"]


def test_formats(spark):
    df = spark.createDataFrame([(1.234, 5.678, 12345)], "a double, b double, n long")
    r = df.select(TX.pct_range("a", "b"), TX.pct("a"), TX.thousands("n"),
                  TX.cut(F.lit("abcdef"), 3)).first()
    assert tuple(r) == ("1.23% ~ 5.68%", "1.23%", "12,345", "abc...")


def test_null_tokens(spark):
    df = one_col(spark, ["N/A", "NULL", "nan", "ok", ""])
    got = [r[0] for r in df.select(TX.null_if_token("v")).collect()]
    assert got == [None, None, None, "ok", None]
