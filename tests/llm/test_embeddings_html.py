"""Embedding links and page text against brute force and written pages."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from prodsearch.llm import embed_dedup, html_text, queries


def brute_links(ids, x, cosine=0.95):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    g = unit @ unit.T >= cosine
    np.fill_diagonal(g, False)
    comp = np.arange(len(x))
    changed = True
    while changed:
        low = np.minimum(comp, np.where(g, comp[None, :], len(x)).min(axis=1))
        changed, comp = bool((low != comp).any()), low
    least = {}
    for c, i in zip(comp, ids):
        least[c] = min(least.get(c, i), i)
    return {i: (int(g[k].sum()), least[comp[k]]) for k, i in enumerate(ids)}


def cloud(n, dim, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for k in range(0, n // 2, 5):           # near copies at many angles, and exact ones
        near = x[k] / np.linalg.norm(x[k])
        for j in range(1, 4):
            x[k + j] = near + rng.normal(size=dim) * rng.choice([0.01, 0.03, 0.04]) * 8 / np.sqrt(dim)
        x[k + 4] = x[k]
    return x.astype(np.float32)


@pytest.mark.parametrize("group", [4096, 300])
def test_recall_against_brute_force(spark, monkeypatch, group):
    """With and without upper levels fitted on a sample."""
    monkeypatch.setattr(embed_dedup, "GROUP", group)
    monkeypatch.setattr(embed_dedup, "LEAF", 64)
    x = cloud(2500, 64, 1)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    want = brute_links(list(range(len(x))), x.astype(np.float64))
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(df).collect()}
    links = sum(w[0] for w in want.values())
    found = sum(r.n_links for r in got.values())
    assert links > 1000 and 0.999 * links <= found <= links
    assert np.mean([got[i].component_id == w[1] for i, w in want.items()]) >= 0.999
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_query_whole_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    want = brute_links([r.vec_id for r in rows], np.array([r.embedding for r in rows], dtype=np.float64))
    got = {r.vec_id: (r.n_links, r.component_id) for r in queries.op3_embedding_dedup(spark, sf).collect()}
    assert got == want


def test_embedding_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]),
            (8, [inf, 1.0]), (9, [None, 1.0]), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.001]), (11, [0.0, 1.0]), (11, [0.0, 1.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, key string, comp int")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0) for r in embed_dedup.near_duplicates(df).collect())
    alone = [(i, 0, i) for i in (4, 5, 6, 7, 8, 9, 10)]
    assert got == sorted([(1, 3, 1), (2, 3, 1), (3, 3, 1), (0, 3, 1), (11, 1, 11), (11, 1, 11), *alone])
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


def test_a_mass_of_near_equal_vectors_in_blocks(spark, monkeypatch):
    """Blocks of a large leaf: right counts, and far fewer rows than pairs."""
    monkeypatch.setattr(embed_dedup, "GROUP", 200)
    monkeypatch.setattr(embed_dedup, "LEAF", 50)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1800, 32))
    x[:700] = x[0] + rng.normal(size=(700, 32)) * 0.05
    x[700:720] = x[1]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = brute_links(list(range(len(x))), x)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_duplicates(df).collect()}
    assert want[0][0] == 719 and got == want
    points = embed_dedup.usable(df, "vec_id", "embedding").dropDuplicates(["key"]).select("key", "v", F.lit(1).cast("long").alias("copies"))
    assert embed_dedup.point_links(points, 32).count() < 30_000 < 700 * 699 / 2


def test_depth_follows_the_number_of_vectors():
    rng = np.random.default_rng(4)
    p = rng.normal(size=(1 << 15, 12))
    at = embed_dedup.fit_tree(p)
    rows, leaf = embed_dedup.route(p, at, 0.0)
    assert len(rows) == len(p) and len(np.unique(leaf)) == 1 << 12
    assert np.bincount(leaf).max() <= 16


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var a="<p>no</p>";</script>
</head><body><header>Site</header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- <p>gone</p> -->
<div class="cookie-notice">Cookies!</div><div class="ad">Buy.</div><aside>Side</aside>
<article><header><h1>Title &eacute;&#33;</h1></header><p>First  <b>bold</b>\n text.<br>More{0}.<p>Second &lt;p&gt;.</p>
<form><input name="q">Search</form><ul><li>One<li>Two</ul><div id="comments"><p>A reader says.</p></div>
<p>Share this</p></article><section class="comments"><p>Nice!</p></section><footer>&copy; me</footer></body></html>"""


def test_written_page(spark):
    df = spark.createDataFrame([(1, "http://h/a/1", PAGE.format(1), 1)], "page_id long, url string, html string, text int")
    r = html_text.main_text(df).first()
    assert r.text.split("\n\n") == ["Title é!", "First bold text. More1.", "Second <p>.", "One", "Two", "Share this"]
    assert r.n_chars == len(r.text)


def test_difference_with_the_nearest_page(spark):
    """Without an article's markup, the lines two pages of a host share go;
    in an article, shared labels do."""
    def page(body):
        return "<html><body><div>Welcome to our site, dear reader of ours.</div>" + "".join(
            f"<p>{x}</p>" for x in body) + "<div>Contact us by mail or phone.</div></body></html>"
    long = ["Quite a long story about number %d, which takes many words to tell in full, and then some." % k for k in range(8)]
    rows = [(k, f"http://one.example/s/{k}?q=1", page([long[2 * k], long[2 * k + 1]])) for k in range(4)]
    rows += [(10, "http://two.example/s/0", page([long[0]])), (11, "http://art.example/1", PAGE.format(1)),
             (12, "http://art.example/2", PAGE.format(2).replace("First", "An entirely other story begins here, told at more length. ").replace(
                 "Second", "It goes on in ways that the first one never thought of, quite unlike it."))]
    got = {r.page_id: r.text.split("\n\n") for r in html_text.main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(4):
        assert got[k] == [long[2 * k], long[2 * k + 1]]
    assert len(got[10]) == 3            # no neighbour to differ from
    assert "Share this" not in got[11] and "Share this" not in got[12]


def test_pages_edges(spark):
    rows = [(1, None, None), (1, None, None), (2, "", ""), (None, "u", "<p>x"), (3, "http://h/a", "<p>cut <b"),
            (4, "http://h/a", "<p>same body text of the page.</p>"), (4, "http://h/a", "<p>same body text of the page.</p>"),
            (5, "http://h/a", "a < b &am"), (6, "http://h/z", "<div class=ad>x</div>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id or 0, r.text) for r in html_text.main_text(df).collect())
    assert got == sorted([(1, ""), (1, ""), (2, ""), (0, "x"), (3, "cut"), (4, "same body text of the page."),
                          (4, "same body text of the page."), (5, "a < b &am"), (6, "")])
    assert html_text.main_text(df.limit(0)).count() == 0


def test_common_lines_is_longest():
    rng = random.Random(4)
    for _ in range(300):
        a = [rng.randrange(5) for _ in range(rng.randrange(9))]
        b = [rng.randrange(5) for _ in range(rng.randrange(9))]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
        got = html_text.common_lines(a, b)
        assert len(got) == t[-1][-1]
        assert all(a[i] == b[j] for i, j in got)
        assert all(x < y and u < v for (x, u), (y, v) in zip(got, got[1:]))


def test_neighbours_cross_task_borders(spark):
    """Every page of a host meets the next, however the order is cut."""
    rows = [(k, f"http://h/{k:03d}", f"<p>page {k} words</p>") for k in range(50)]
    lines = html_text.page_lines(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5),
                                 "page_id", "url", "html")
    assert html_text.neighbours(lines).count() == 49


STORY = "<p>A story that takes a good many words to tell, since it happened long ago.</p>" * 3
LINE = "A story that takes a good many words to tell, since it happened long ago."


@pytest.mark.parametrize("page, want", [
    (f"<div class='content has-sidebar'><nav>Menu</nav><article>{STORY}</article></div>", [LINE] * 3),
    (f"<div class='content no-sidebar'><div class=sidebar>Links</div>{STORY}</div>", [LINE] * 3),
    (f"<article><header class='entry-header'><h1>Its title</h1></header>{STORY}</article>", ["Its title"] + [LINE] * 3),
    (f"<article><div class='entry-header'><h1>Its title</h1></div>{STORY}<div class=share>Share</div></article>",
     ["Its title"] + [LINE] * 3),
    (f"<form id=f><header>Site</header><input name=q><main>{STORY}</main><footer>me</footer></form>", [LINE] * 3),
    (f"<form id=f><nav>Menu</nav>{STORY}</form>", [LINE] * 3),
    (f"<div>{STORY}</div><article><p>Teaser of another story.</p></article>", [LINE] * 3 + ["Teaser of another story."]),
    (f"<article>{STORY}</article><div class=related><article><p>Teaser.</p></article></div><ul><li>Home<li>News</ul>", [LINE] * 3),
    (f"<article><p>Short.</p></article><section class=comments>{STORY}</section>", ["Short."]),
    (f"<div style='display:none'><article>{STORY}</article></div><p>Seen.</p>", ["Seen."]),
    (f"<nav>{STORY}</nav><p>Seen.</p>", ["Seen."]),
])
def test_markup_does_not_lose_the_article(page, want):
    got = [t for t, _ in html_text.candidates(f"<html><body class='has-sidebar'>{page}</body></html>")]
    assert got == want


def test_templates_copies_and_stubs(spark):
    """A template heavier than the articles goes; copies keep their text but
    not the template; a stub does not protect its neighbour."""
    def words(n, tag):
        return " ".join(f"{tag}{i}" for i in range(n)) + "."

    def page(*lines):
        return "<html><body>" + "".join(f"<p>{x}</p>" for x in lines) + "</body></html>"
    top, end = words(30, "top"), words(30, "end")
    rows = [(k, f"http://heavy.example/{k}", page(top, words(40, f"k{k}x"), end)) for k in range(6)]
    story = [words(20, f"s{i}") for i in range(6)]
    near = {k: [*story[:5], words(20, f"n{k}x")] for k in range(3)}
    rows += [(10 + k, f"http://copies.example/b{k}", page(top, *near[k], end)) for k in range(3)]
    rows += [(20 + k, f"http://copies.example/b1?again={k}", page(top, *near[1], end)) for k in range(3)]
    rows += [(30 + k, f"http://copies.example/{c}", page(top, words(90, f"o{k}x"), end)) for k, c in enumerate("acdefg")]
    rows += [(40, "http://stub.example/a", page(top)), (41, "http://stub.example/b", page(top, words(90, "long")))]
    rows += [(50 + k, f"http://only.example/{k}", page(*near[k])) for k in range(3)]
    got = {r.page_id: r.text.split("\n\n") for r in html_text.main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(6):
        assert got[k] == [words(40, f"k{k}x")]
        assert got[30 + k] == [words(90, f"o{k}x")]
    for k in range(3):
        assert got[10 + k] == near[k] and got[20 + k] == near[1] and got[50 + k] == near[k]
    assert got[41] == [words(90, "long")]
