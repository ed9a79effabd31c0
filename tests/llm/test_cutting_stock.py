"""Cutting-stock packing: the plan, round trips and padding."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from prodsearch.llm import cutting_stock as C
from prodsearch.llm import queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def lib():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def lay_out(plan, histogram):
    """{sequence: [(offset, length)]} of all rests, and how many are cut."""
    length = np.repeat(list(histogram), list(histogram.values())).astype(np.int64)
    rank = np.concatenate([np.arange(n) for n in histogram.values()]).astype(np.int64)
    row, skipped, n, seq, offset, cut = C.place(plan, length, rank)
    got = {}
    for r, s, k in zip(row.tolist(), skipped.tolist(), n.tolist()):
        got.setdefault(r, []).append((s, k))
    for r in range(len(length)):
        at = 0
        for s, k in sorted(got[r]):
            assert s == at and k > 0
            at += k
        assert at == length[r]
    out = {}
    for s, o, k in zip(seq.tolist(), offset.tolist(), n.tolist()):
        out.setdefault(s, []).append((o, k))
    for s, parts in out.items():
        at = 0
        for o, k in sorted(parts):
            assert o == at, (s, parts)
            at += k
        assert at <= plan.capacity
    assert {r for r, c in zip(row.tolist(), cut.tolist()) if c} == {r for r, p in got.items() if len(p) > 1}
    return out, sum(len(p) > 1 for p in got.values())


def padded(out, capacity):
    fill = np.array([sum(k for _, k in parts) for parts in out.values()])
    return int(C.padding(fill, capacity).sum())


@pytest.mark.parametrize("seed", range(8))
def test_plan_places_every_rest_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([16, 50, 128])
    lengths = rng.sample(range(1, capacity), rng.randint(1, capacity - 1))
    histogram = {x: rng.choice([1, 2, 7, 60, 500]) for x in lengths}
    out, _ = lay_out(C.make_plan(histogram, capacity), histogram)
    sequences = len(out)
    total = sum(x * n for x, n in histogram.items())
    assert padded(out, capacity) <= C.MAX_PAD * sequences
    assert sequences >= total / capacity


def test_real_shape_has_no_padding_and_few_cuts():
    rng = np.random.default_rng(2)
    x = np.minimum(rng.lognormal(6, 1.2, 60_000).astype(int) + 1, 200_000) % 1024
    lengths, counts = np.unique(x[x > 0], return_counts=True)
    histogram = dict(zip(lengths.tolist(), counts.tolist()))
    out, cuts = lay_out(C.make_plan(histogram), histogram)
    tokens = int((lengths * counts).sum())
    assert padded(out, 1024) <= 2e-4 * tokens
    assert cuts <= 0.02 * counts.sum()
    assert len(out) <= 1.01 * tokens / 1024


def test_one_length_only():
    """All rests of 600: nothing fits together, so runs are cut, not padded."""
    out, cuts = lay_out(C.make_plan({600: 1000}), {600: 1000})
    assert padded(out, 1024) == 0
    assert cuts < 700 and len(out) < 800


def brute_knapsack(lengths, value, capacity):
    best = [0] + [-np.inf] * capacity
    for t in range(1, capacity + 1):
        best[t] = max([best[t - x] + v for x, v in zip(lengths, value) if x <= t], default=-np.inf)
    return best


def test_knapsack():
    rng = np.random.default_rng(5)
    for _ in range(20):
        lengths = np.sort(rng.choice(np.arange(1, 60), rng.integers(1, 20), replace=False))
        value = rng.normal(size=len(lengths))
        best, item = C.knapsack(lengths, value, 60)
        assert np.allclose(best, brute_knapsack(lengths, value, 60))
        for t in np.flatnonzero(item >= 0):
            at, got = int(t), 0.0
            while at:
                got += value[item[at]]
                at -= lengths[item[at]]
            assert np.isclose(got, best[t])


def test_columns_solve_the_program():
    """Lengths that only certain threes fill: greedy wastes, the columns don't."""
    lengths, counts = np.array([20, 30, 35, 50]), np.array([600.0, 400.0, 400.0, 100.0])
    patterns, uses = C.generate_columns(lengths, counts, 100)
    used = np.zeros(4)
    for p, u in zip(patterns, uses):
        assert sum(lengths[i] * a for i, a in p.items()) <= 100
        for i, a in p.items():
            used[i] += a * u
    assert np.allclose(used, counts)
    # 30+35+35, 20x5, 30+20+50, 50+50: full sequences only
    assert np.isclose(uses.sum(), lengths @ counts / 100, rtol=0.02)


def check(rows, texts, lib):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for i, t in texts.items():
        ids = lib.encode(t or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    pad = 0
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 1024
        pad += 0 if at & (at - 1) == 0 else 1024 - at
    return pad


def test_round_trip(docs_of, lib):
    rng = random.Random(4)
    texts = [None, "", "a b c"] + [" ".join(rng.choice(["cat", "dog's", "é.", "12"]) for _ in range(
        rng.choice([3, 50, 400, 1500, 4000]))) for _ in range(60)]
    rows = C.pack(docs_of(texts, offset="clash", rank=3, task="x"), PATH).collect()
    assert check(rows, dict(enumerate(texts)), lib) <= C.MAX_PAD * len(rows)


def test_query_on_driver_table(spark, sf, lib):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op11_cutting_stock(spark, sf).collect()
    assert check(rows, texts, lib) <= C.MAX_PAD * len({r.sequence_id for r in rows})


def test_edges(docs_of):
    same = docs_of([(1, "x y", None, None, None)] * 7 + [(None, None, None, None, None)])
    got = C.pack(same, PATH).collect()
    assert sum(r.length for r in got) == 7 * 3 + 1
    assert C.pack(same.limit(0), PATH).count() == 0
    hot = docs_of([(k % 3, "word " * 599, None, None, None) for k in range(40)]).repartition(5)
    rows = C.pack(hot, PATH).collect()
    assert sum(r.length for r in rows) == sum({(r.doc_id, r.doc_tokens): r.doc_tokens for r in rows}.values()) // 3 * 40
