"""Secret scans: the patterns against a plain reading, the test battery on
random and ordinary tokens."""

import base64
import hashlib
import random
import re

from prodsearch.llm import queries, secret_scan


def plain_base(text):
    """The patterns as stated: find with ``+``, then drop the short ones."""
    text = text or ""
    out = []
    assign = re.compile(r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"
                        r"[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?"
                        r"([A-Za-z0-9+/_.=-]+)")
    for m in assign.finditer(text):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 18:
            out.append((m.start(), 1, f"access:{m.start()}:{m.end()}"))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 16:
            out.append((m.start(), 2, f"hex:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


def secret_texts():
    rng = random.Random(9)
    parts = ["token = \"", "PassWord:", "api_key='", "ſecret: abcdefghijklmnop ", "secret=", "AKIA", "AKIAAKIA",
             "ABCDEF0123456789", "deadbeefdeadbeef", "0123456789abcdef0", "short", " ", "\n", "é\U0001F600",
             "token: password: abcdefghijklmnop", "= ", "\"", "x" * 13]
    out = [None, "", "plain text only"]
    out += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(400)]
    return out


def test_base_spans(docs_of):
    texts = secret_texts()
    rows = {r.doc_id: r for r in secret_scan.scan(docs_of(texts, base="clash")).collect()}
    for i, t in enumerate(texts):
        assert rows[i].base == plain_base(t), repr(t)
        assert rows[i].n_hex == plain_base(t).count("hex:")
        assert set(filter(None, rows[i].base.split(","))) <= set(rows[i].spans.split(","))


def test_query_digest(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op4_secrets(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert r.n_assign == base.count("assign:") and r.n_access == base.count("access:")


def test_random_tokens_found_and_words_left(docs_of):
    rng = random.Random(10)
    made = [base64.b64encode(rng.randbytes(30)).decode() for _ in range(60)]
    words = ["internationalization2017", "configuration_version_12345", "HTTPServerRequestHandler2",
             "2024-01-01_backup_of_all_files", "/usr/local/lib/python3/site-packages", "aaaaaaaaaaaaaaaaaaaaaaaa1",
             "12345678901234567890123", "abcdefghijklmnopqrstuvwxyz0123456789"]
    texts = [f"some words {s} and more" for s in made + words]
    rows = {r.doc_id: r for r in secret_scan.scan(docs_of(texts)).collect()}
    found = sum("random:" in rows[i].spans for i in range(len(made)))
    assert found >= 0.8 * len(made)
    for i in range(len(made)):
        if "random:" in rows[i].spans:
            k, s, e = rows[i].spans.split(",")[0].split(":")
            assert texts[i][int(s):int(e)] == made[i]
    # digits and runs of one letter are the hex pattern's; none is random
    assert not any("random:" in rows[len(made) + i].spans for i in range(len(words)))


def test_false_discovery_cells():
    # 10 strong claims of a band pass; 1000 weak ones of another don't
    assert secret_scan.false_discovery_cells([(1, 40, 10), (1, 0, 20), (2, 1, 1000)]) == {1: 40}
    assert secret_scan.false_discovery_cells([]) == {}


def test_redaction(docs_of):
    t = 'first token = "abcdefghijklmnop" then deadbeefdeadbeefdeadbeef end'
    df = docs_of([(1, t, None, None, len(t)), (2, None, None, None, None), (3, "clean", "en", "s", 5)], __extra="x")
    out = {r.doc_id: r for r in secret_scan.without_secrets(df).collect()}
    assert secret_scan.without_secrets(df).columns == df.columns
    assert out[1].text == 'first [secret]" then [secret] end' and out[1].n_chars == len(out[1].text)
    assert out[2].text is None and out[3].text == "clean"
    assert secret_scan.without_secrets(df.limit(0)).count() == 0


def spans_of(docs_of, texts):
    rows = {r.doc_id: r for r in secret_scan.scan(docs_of(texts)).collect()}
    return [[(int(s), int(e)) for k, s, e in (x.split(":") for x in rows[i].spans.split(",") if x) if k == "random"]
            for i in range(len(texts))]


def test_random_tokens_after_equals_signs_and_in_urls(docs_of):
    rng = random.Random(11)
    frames = ["AWS_SECRET_ACCESS_KEY=%s", "see https://h.example/a?sig=%s&x=1 there", "?sig=%s", "x=%s;",
              "export SESSION_SIGNING_SALT=%s\n", "get https://h.example/files/of/all/users/%s/download now"]
    made = [(f, base64.urlsafe_b64encode(rng.randbytes(30)).decode()) for f in frames for _ in range(30)]
    texts = [f % s for f, s in made]
    for f in frames:
        got = [any(t[a:b].find(s) >= 0 for a, b in sp)
               for (g, s), t, sp in zip(made, texts, spans_of(docs_of, texts)) if g == f]
        assert sum(got) >= 0.8 * len(got), f
    # a name is no secret, and padding is not the sign before a value
    assert spans_of(docs_of, ["AWS_SECRET_ACCESS_KEY_OF_ALL=x", "a_long_name_of_a_setting=" + "word " * 5]) == [[], []]


def test_random_letters_and_ordinary_words(docs_of):
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    made = ["".join(rng.choices(letters + letters.upper(), k=40)) for _ in range(40)]
    made += ["".join(rng.choices(letters, k=64)) for _ in range(40)]
    words = ["internationalization", "Donaudampfschifffahrtsgesellschaft", "abstractSingletonProxyFactoryBean",
             "RequestHandlerFactoryImplementation", "ALL_RIGHTS_RESERVED_BY_OWNER", "this-is-a-long-slug-of-a-page",
             "anticonstitutionnellement", "Rechtsschutzversicherungsgesellschaften"]
    found = spans_of(docs_of, ["a " + x + " z" for x in made + words])
    assert sum(map(bool, found[:40])) >= 32 and sum(map(bool, found[40:80])) >= 28
    assert not any(found[80:])


def test_random_token_around_a_pattern(docs_of):
    """The rest of a random token that holds a shorter pattern's span."""
    rng = random.Random(13)
    texts = []
    for _ in range(20):
        a, b = (base64.b64encode(rng.randbytes(24)).decode() for _ in range(2))
        texts.append(f"key {a}{'%016x' % rng.getrandbits(64)}X{b} end")
    found = spans_of(docs_of, texts)
    assert sum(map(bool, found)) >= 16
    out = [r.text for r in secret_scan.without_secrets(docs_of(texts)).collect()]
    assert sum(t == "key [secret] end" for t in out) >= 16
