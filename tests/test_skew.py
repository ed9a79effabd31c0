"""One key holding a third of all rows: results stay exact, and plans cut
the hot key down before the shuffle (partial WindowGroupLimit or partial
aggregation)."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from prodsearch.operators import clean, dialog, joins, stats


def plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def skewed(spark):
    """conv 0 holds 3000 of ~9000 messages; the rest have 2-8 each."""
    rows = [(0, t, "user" if t % 2 == 0 else "assistant", f"w{t % 13} text {t}") for t in range(3000)]
    conv, turn = 1, 0
    for i in range(6000):
        rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", f"w{i % 13} x {i}"))
        turn += 1
        if turn >= 2 + conv % 7:
            conv, turn = conv + 1, 0
    return (spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
            .repartition(6), rows)


def test_last_n_hot_conversation(skewed):
    df, rows = skewed
    out = dialog.last_n(df, 20)
    assert "WindowGroupLimit" in plan(out)
    hot = sorted(r.turn for r in out.where("conv_id = 0").collect())
    assert hot == list(range(2980, 3000))
    per_conv = {}
    for c, t, _, _ in rows:
        per_conv[c] = per_conv.get(c, 0) + 1
    assert out.count() == sum(min(20, n) for n in per_conv.values())


def test_overflow_hot_conversation(skewed):
    df, _ = skewed
    out = dialog.overflow_trim(df)
    p = plan(out)
    assert "WindowGroupLimit" in p and "HashAggregate" in p
    assert out.where("conv_id = 0").count() == 14


def test_newest_marked_hot_conversation(skewed):
    df, rows = skewed
    out = dialog.newest_where(df, F.col("text").contains("w5"), "text")
    p = plan(out)
    assert "partial_max" in p and "SortAggregate" not in p
    want = max((t, x) for c, t, _, x in rows if c == 0 and "w5" in x)[1]
    assert out.where("conv_id = 0").first().text == want


def test_keep_first_hot_key(spark):
    rows = [(i, "hot", "p") for i in range(5000)] + [(5000 + i, f"c{i}", "p") for i in range(2500)]
    df = spark.createDataFrame(rows, "pos long, co string, prd string").repartition(5)
    out = clean.keep_first(df, ["co", "prd"], ["pos"])
    assert "WindowGroupLimit" in plan(out)
    assert out.where("co = 'hot'").first().pos == 0
    assert out.count() == 2501


def test_grounding_hot_conversation(skewed):
    df, rows = skewed
    answers = df.where("role = 'assistant'")
    names = df.where("role = 'user'").select("conv_id", F.split_part("text", F.lit(" "),
                                                                       F.lit(1)).alias("name"))
    got = {(r.conv_id, r.turn): r.grounded
           for r in joins.grounding(answers, names, "conv_id", "turn", "text", "name").collect()}
    cand = {}
    for c, t, role, x in rows:
        if role == "user":
            cand.setdefault(c, set()).add(x.split(" ")[0])
    want = {(c, t): (None if c not in cand else int(any(n in x for n in cand[c])))
            for c, t, role, x in rows if role == "assistant"}
    assert got == want


def test_division_counts_hot_division(spark):
    rows = [("D", i % 3, 1) for i in range(3000)] + [(f"X{i}", 0, 1) for i in range(6000)]
    df = spark.createDataFrame(rows, "d string, g int, t int")
    out = stats.division_counts(df, "d", ["g"], F.col("t"))
    assert "partial_count" in plan(out)
    assert out.where("d = 'D'").first().records == 3000
