"""Quality rules and mixing against brute force, SQL and edge cases."""

import random
import re

import pytest

from prodsearch.llm import mixing, quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_repeat(text):
    w = WORD.findall(text or "")
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    hit = {p for at in seen.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    return len(hit)


def test_repeat_words_and_counts(docs_of):
    rng = random.Random(3)
    texts = [None, "", " \n\t ", "one two three", "a b c d e f g h a b c d e f g h", "x " * 40,
             "a|b <c> #\U0001F600 é\n\nsame line.\nsame line.\n same line."]
    for _ in range(30):
        texts.append(" ".join(rng.choice("abc") for _ in range(rng.randint(1, 120))))
    got = {r.doc_id: r for r in quality.measure(docs_of(texts)).collect()}
    for i, t in enumerate(texts):
        w = WORD.findall(t or "")
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        assert got[i].n_words == len(w)
        assert got[i].word_chars == sum(map(len, w))
        assert got[i].n_symbols == sum(c in "#*$%&|<>" for c in t or "")
        assert got[i].n_dup_lines == len(lines) - len(set(lines))
        assert got[i].n_repeat_words == brute_repeat(t), t
        assert got[i].base_failed == (len(w) < 20 or 100 * brute_repeat(t) > 30 * len(w))
        assert not (got[i].base_failed and got[i].kept)


def test_line_rules(docs_of):
    prose = "This is a plain sentence with several words in it, and it ends well."
    other = "Another quite ordinary sentence follows here so that the text has enough words."
    bad = ["home | about | contact | help", "no sentence ends in this line at all",
           "All rights reserved by the owner.", "BUY!! NOW!! IT!! IS!! CHEAP!!", "w### x$$$ y%%% z&&&."]
    rows = docs_of(["\n".join([prose, b, other]) for b in bad] + [prose + "\n\n" + other])
    for r in quality.measure(rows).collect():
        assert r.kept
        assert r.kept_text == (prose + "\n" + other if r.doc_id < len(bad) else prose + "\n\n" + other)
    junk = docs_of(["\n".join(f"{chr(97 + k)} | b | c | d | e" for k in range(9))])
    assert not quality.measure(junk).first().kept


def test_clean_keeps_columns(docs_of):
    t = " ".join(f"w{i}" for i in range(30)) + "."
    df = docs_of([(1, t, None, None, None), (1, t, None, None, None), (None, t, "en", "s", 3), (4, None, None, None, 0)],
                 kept=5, n_words="x")
    out = quality.clean(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0, r.kept, r.n_words, r.n_chars) for r in out.collect()) == [
        (0, 5, "x", len(t)), (1, 5, "x", len(t)), (1, 5, "x", len(t))]
    assert quality.clean(df.limit(0)).count() == 0


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_key_matches_sql(spark, sf, key):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    res = con.execute(queries.ORACLE[key])
    cols = [c[0] for c in res.description]
    df = queries.QUERIES[key](spark, sf)
    assert sorted(df.columns) == sorted(cols)
    assert sorted(map(tuple, df.select(cols).collect())) == sorted(res.fetchall())


def brute_targets(sizes, weights=(5, 2, 1), m=3):
    """Repeated resharing, as stated."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in stopped]
        left = total - sum(stopped.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > m * sizes[s]]
        if not over:
            return stopped | share
        stopped |= {s: m * sizes[s] for s in over}


def test_mixing_targets_and_taken(docs_of):
    rng = random.Random(5)
    sources = ["a", "b", "é", "Z", None, "empty"]
    rows = []
    for i in range(400):
        s = rng.choices(sources, [150, 3, 60, 2, 10, 2])[0]
        n = 0 if s == "empty" else rng.choice([0, 1, 5, 40])
        rows.append((i, None if n == 0 and i % 2 else "w " * n, "en", s, n))
    m = mixing.mix(docs_of(rows)).collect()
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    want, taken = brute_targets(sizes), dict.fromkeys(sizes, 0)
    assert len(m) == len(rows)
    for r in m:
        assert r["__mix_target"] == pytest.approx(want[r.source])
        assert r["__mix_source_size"] == sizes[r.source]
        assert 0 <= r["__mix_copies"] <= 3
        taken[r.source] += r["__mix_copies"] * r["__mix_size"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 20 + 1e-6       # half the largest document


def test_mixing_edges(docs_of, spark):
    same = [(7, "a b c", "en", "s", 5)] * 5 + [(None, "x y", None, None, None)]
    df = docs_of(same, size=1, skey="clash", h=2)
    out = mixing.mix(df)
    assert out.count() == 6 and set(df.columns) < set(out.columns)
    assert mixing.mix(df.limit(0)).count() == 0
    again = [sorted(map(str, mixing.mixed_documents(df).collect())) for _ in range(2)]
    assert again[0] == again[1] and mixing.mixed_documents(df).columns == df.columns
    only_empty = mixing.mix(docs_of([None, ""])).collect()
    assert [r["__mix_target"] for r in only_empty] == [0.0, 0.0]
