"""The pipeline stage by stage against brute force, each on its own input."""

import duckdb
import public_tokenizers
import pytest

import corpus_pipeline
from prodsearch.llm import queries, secret_scan
from test_ngram_join import grams


def test_stages_on_their_own_inputs(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [docs.collect()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / str(k))
        df = stage(spark, docs, sf)
        assert k == 4 or df.columns == docs.columns
        df.write.parquet(out)
        docs = spark.read.parquet(out)
        rows.append(docs.collect())
    source, clean, unique, redacted, mixed, packed = rows

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.execute(f"WITH {queries.quality_ctes()} SELECT doc_id, kept_text FROM judged WHERE kept").fetchall()
    assert sorted((r.doc_id, r.text) for r in clean) == sorted(want)
    assert 0.5 * len(source) < len(clean) < len(source)

    # one of each group stays, and it has the smallest id
    sets = {r.doc_id: grams(r.text, 5) for r in clean}
    ids, kept = sorted(sets), {r.doc_id for r in unique}
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, i in enumerate(ids):
        for j in ids[:x]:
            same = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * same >= 80 * (len(sets[i]) + len(sets[j]) - same):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert kept == {root(i) for i in ids} and len(unique) == len(kept) < len(clean)

    text = {r.doc_id: r.text for r in unique}
    assert {r.doc_id for r in redacted} == kept
    for r in redacted:
        if not secret_scan.base_spans(text[r.doc_id]) and not secret_scan.claims(text[r.doc_id]):
            assert r.text == text[r.doc_id]
        assert not secret_scan.base_spans(r.text) and r.n_chars == len(r.text)

    con.register("redacted", spark.read.parquet(str(tmp_path / "2")).toArrow())
    want = con.execute(f"WITH {queries.mixing_ctes('redacted')} SELECT doc_id, copies FROM mixed").fetchall()
    got = {}
    for r in mixed:
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {d: c for d, c in want if c}

    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = sum(len(e.ids) + 1 for e in lib.encode_batch([r.text for r in mixed], add_special_tokens=False))
    assert sum(r.length for r in packed) == tokens
    sequences = len({r.sequence_id for r in packed})
    assert tokens / 1024 <= sequences <= 1.05 * tokens / 1024 + 1


def test_run_equals_the_stages(spark, sf):
    first, second = (sorted(map(str, corpus_pipeline.run(spark, sf).select(
        "doc_id", "piece", "start", "length", "ids_crc32").collect())) for _ in range(2))
    assert first == second and first


@pytest.mark.parametrize("k", range(5))
def test_stage_edges(spark, docs_of, k):
    """Nulls in every column, repeated rows, no rows."""
    t = " ".join(f"word{i}" for i in range(40)) + "."
    df = docs_of([(None, None, None, None, None), (1, t, None, None, None), (1, t, None, None, None), (2, "", "en", "s", 0)])
    stage = corpus_pipeline.STAGES[k][1]
    assert stage(spark, df, "").count() >= 1
    assert stage(spark, df.limit(0), "").count() == 0
