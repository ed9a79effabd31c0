"""Every registered query against its oracle SQL on the sf0.001 tables
(the same check the driver runs at sf0.01), plus the entry smoke test."""

import os
import sys

import pytest

import __spark_entry__ as E

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    from check_oracle import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_key_has_oracle_or_is_rows_only():
    assert not set(E.QUERIES) - set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["query_id", "status", "recommendation", "conversation_turns",
                          "n_results", "names"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(set(E.oracle_sql()) & set(E.QUERIES)))
def test_key_matches_oracle(spark, duck, key):
    from check_oracle import digest, spark_types

    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    ocols = [c[0] for c in res.description]
    otypes = {c[0]: str(c[1]) for c in res.description}
    orows = [tuple(r) for r in res.fetchall()]
    assert sorted(df.columns) == sorted(ocols)
    assert spark_types(df) == otypes
    assert len(rows) == len(orows)
    assert digest(rows, df.columns)[0] == digest(orows, ocols)[0]


def test_keys_run_their_operators(spark, monkeypatch):
    """The keys call the operators they stand for, not a copy of them."""
    from prodsearch.operators import retrieve
    from prodsearch.plans import collect, recommend
    from prodsearch.sources import pages

    runs = {"envelope_quarantine": (pages, "quarantine"), "group_completeness": (pages, "complete_groups"),
            "parse_analysis_json": (recommend, "analysis_from_json"), "build_prompts": (recommend, "prompts"),
            "response_rows": (recommend, "response_rows"), "job_collect": (collect, "merge_records"),
            "job_collect_counts": (collect, "record_counts"), "job_recommend": (recommend, "recommend"),
            "embed_texts": (retrieve, "fit_embed"), "embed_queries": (retrieve, "embed")}
    for key, (module, name) in runs.items():
        called = []
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, _f=real, **k: called.append(1) or _f(*a, **k))
        E.queries()[key](spark, SF)
        assert called, key
        monkeypatch.setattr(module, name, real)
