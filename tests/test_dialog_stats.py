"""Conversation windows (W1-W6) and aggregations."""

from pyspark.sql import functions as F

from prodsearch import schemas as S
from prodsearch.functions import text as TX
from prodsearch.operators import clean, dialog, stats


def conv(spark, n, conv_id=1, text="msg"):
    rows = [(conv_id, t, "user" if t % 2 == 0 else "assistant", f"{text}{t}") for t in range(n)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_overflow_auto_reset_manual(spark):
    df = conv(spark, 19, 1).unionByName(conv(spark, 20, 2)).unionByName(conv(spark, 25, 3))
    auto = {r.conv_id: r.n for r in dialog.overflow_trim(df).groupBy("conv_id")
            .agg(F.count("*").alias("n")).collect()}
    assert auto == {1: 19, 2: 14, 3: 14}
    kept = dialog.overflow_trim(df).where("conv_id = 3").agg(F.min("turn")).first()[0]
    assert kept == 11  # the newest 14 of turns 0..24
    reset = {r.conv_id for r in dialog.overflow_trim(df, policy="reset").collect()}
    assert reset == {1}
    assert dialog.overflow_trim(df, policy="manual").count() == 64
    counts = {r.conv_id: (r.kept, r.dropped) for r in dialog.overflow_counts(df).collect()}
    assert counts == {1: (19, 0), 2: (14, 6), 3: (14, 11)}


def test_last_n_and_turn_counts(spark):
    df = conv(spark, 25, 1)
    assert sorted(r.turn for r in dialog.last_n(df, 20).collect()) == list(range(5, 25))
    assert stats.turn_counts(df).first().turns == 12


def test_last_recommended_needs_both_markers(spark):
    rows = [(1, 0, "user", "q"),
            (1, 1, "assistant", "📍 추천 상품: 오래된상품\n📍 금융회사: 은행A"),
            (1, 2, "user", "q2"),
            (1, 3, "assistant", "📍 **추천 상품**: 새상품 만 있음")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = dialog.last_recommended(df).first()
    assert (r.product, r.company) == ("오래된상품", "은행A")


def test_context_note_newest_and_oldest(spark):
    rows = [(1, t, "assistant" if t % 2 else "user",
             f"📍 추천 상품: P{t}" if t in (1, 5, 7) else f"m{t}") for t in range(8)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    mre = TX.marker_regex(S.PRODUCT_MARKER, allow_bold=False)
    newest = dialog.context_note(df, mre).first().note
    oldest = dialog.context_note(df, mre, oldest=True).first().note
    assert newest == S.CONTEXT_NOTE_PREFIX + "📍 추천 상품: P7..."
    assert oldest == S.CONTEXT_NOTE_PREFIX + "📍 추천 상품: P5..."  # turn 1 is outside the last 6


def test_append_turns(spark):
    hist = conv(spark, 3, 1)
    new = spark.createDataFrame([(1, "q", "a"), (2, "q2", "a2")],
                                "conv_id long, question string, answer string")
    out = {(r.conv_id, r.turn, r.role, r.text) for r in dialog.append_turns(hist, new).collect()}
    assert (1, 3, "user", "q") in out and (1, 4, "assistant", "a") in out
    assert (2, 0, "user", "q2") in out and (2, 1, "assistant", "a2") in out


def test_keep_first_is_stable_and_idempotent(spark):
    rows = [(i, "co", "p", 6 * (i + 1)) for i in range(3)] + [(9, "co", "q", 1)]
    df = spark.createDataFrame(rows, "pos long, kor_co_nm string, fin_prdt_nm string, save_trm int")
    once = clean.keep_first(df.repartition(3), ["kor_co_nm", "fin_prdt_nm"], ["pos"])
    got = {(r.fin_prdt_nm, r.save_trm) for r in once.collect()}
    assert got == {("p", 6), ("q", 1)}
    twice = clean.keep_first(once, ["kor_co_nm", "fin_prdt_nm"], ["pos"])
    assert {tuple(r) for r in twice.collect()} == {tuple(r) for r in once.collect()}


def test_range_stats_skips_empty(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 3.0, None), ("b", None, 2.0)],
                               "g string, x double, y double")
    got = {(r.g, r.metric): (r.lo, r.hi, r.mean)
           for r in stats.range_stats(df, ["g"], ["x", "y"]).collect()}
    assert got == {("a", "x"): (1.0, 3.0, 2.0), ("b", "y"): (2.0, 2.0, 2.0)}


def test_availability_ratio_empty_is_null(spark):
    df = spark.createDataFrame([], "g string, etc string")
    assert stats.availability_ratio(df, [], F.col("etc").isNotNull()).first().pct is None


def test_type_distribution_labels(spark):
    df = spark.createDataFrame([("deposit",)] * 3 + [("x",)], "t string")
    got = {r.t: (r.n, r.n_text) for r in
           stats.type_distribution(df, "t", labels=S.PRODUCT_TYPE_LABELS).collect()}
    assert got == {"정기예금": (3, "3"), "x": (1, "1"), "ALL": (4, "4")}


def test_division_counts(spark):
    df = spark.createDataFrame([("D", "g1", 5), ("D", "g1", 5), ("D", "g2", 7), ("S", "g3", 1)],
                               "d string, g string, total int")
    got = {r.d: (r.records, r.reported)
           for r in stats.division_counts(df, "d", ["g"], F.col("total")).collect()}
    assert got == {"D": (3, 12), "S": (1, 1)}
