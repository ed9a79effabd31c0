"""Token counts and packing against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from prodsearch.llm import packing, pretokens, token_count

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def lib():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def odd_texts():
    rng = random.Random(1)
    alphabet = ["a", "Word", "été", "1234", " ", "  ", "\n", "\t", ".", "!?", "'s", "<|endoftext|>", "\x1c",
                "\xa0", " ", "汉字", "\U0001F600", "é", "ſ", "Ⅷ", "²", "_", "\r\n", "ß", "Ǆ", "×"]
    out = ["", " ", "\n", "a", " a", "a ", "a  b", "a \n b", "a\x1c b", "x <|endoftext|> y", "<|endoftext|>",
           "it's we'll", " leading", "trail "]
    out += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(600)]
    out += [" ".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    return out


def test_ids_equal_the_library(lib):
    e = pretokens.TextEncoder(PATH)
    for t in odd_texts():
        want = lib.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(e.ids(t), "<u4").tolist() == want, repr(t)
        assert e.count(t) == len(want)


def test_column_ids_equal_the_library(lib, monkeypatch):
    """Whole columns, with slices and caches small enough to turn over."""
    import pyarrow as pa

    texts = [None, *odd_texts(), "été, Ça; va? x.y, \u00d7, 3.5, don't! a<|endoftext|>, b", "\n", "a,\nb.\nc"]
    texts += [f"w{i} Wort{i}, é{i}. <|endoftext|>\nab{i % 7}; ß!" for i in range(300)] + ["long " * 30_000]
    for size, kept in ((6 << 20, 48 << 20), (500, 2_000)):
        monkeypatch.setattr(pretokens, "SLICE_BYTES", size)
        monkeypatch.setattr(pretokens, "KEPT_BYTES", kept)
        e = pretokens.TextEncoder(PATH)
        for _ in range(2):
            for t, got in zip(texts, e.column_ids(pa.array(texts, pa.string())), strict=True):
                assert np.frombuffer(got, "<u4").tolist() == lib.encode(t or "", add_special_tokens=False).ids, repr(t)
    assert list(e.column_ids(pa.array([], pa.string()))) == []


def test_single_characters(lib):
    """Every Latin character in each place of a chunk, as the letter class of
    the fast path must agree with the library's."""
    e = pretokens.TextEncoder(PATH)
    for c in map(chr, range(0x250)):
        for t in (c, f"a{c}b", f"a {c}", f"{c}. x", f"a{c} {c}b"):
            assert np.frombuffer(e.ids(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)
    import pyarrow as pa

    texts = [x for c in map(chr, range(0x250)) for x in (f"{c}. x", f"a{c}, {c}b\n{c}!", f"x {c}")]
    for t, got in zip(texts, e.column_ids(pa.array(texts))):
        assert np.frombuffer(got, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_counts(docs_of, lib):
    texts = [None, *odd_texts()[:200], "word " * 3000]
    df = docs_of(texts + [texts[-1]], n_tokens="clash")
    got = {r.doc_id: r for r in token_count.count_tokens(df, PATH).collect()}
    assert len(got) == len(texts) + 1
    for i, t in enumerate(texts + [texts[-1]]):
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 1024)
    assert token_count.count_tokens(df.limit(0), PATH).count() == 0


def test_counts_null_ids(docs_of):
    big = (1 << 60) + 1
    rows = token_count.count_tokens(docs_of([(None, "a", None, None, None), (big, "a b", None, None, None)]), PATH)
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows.collect()) == [(0, 1), (big, 2)]


def brute_best_fit(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if capacity - sum(b) >= n]
        (max(fits, key=sum) if fits else bins.append([]) or bins[-1]).append(n)
    return bins


def test_best_fit_decreasing():
    rng = random.Random(2)
    for _ in range(50):
        lengths = [rng.randint(1, 100) for _ in range(rng.randint(0, 80))]
        bins, offsets = packing.best_fit_decreasing(lengths, 100)
        want = sorted(sum(b) for b in brute_best_fit(lengths, 100))
        fill = {}
        for n, b, o in zip(lengths, bins, offsets):
            fill.setdefault(b, []).append((o, n))
        for places in fill.values():
            at = 0
            for o, n in sorted(places):
                assert o == at
                at += n
            assert at <= 100
        assert sorted(sum(n for _, n in p) for p in fill.values()) == want


def test_pack_round_trip(docs_of, lib):
    rng = random.Random(4)
    texts = [None, "", "a b c"] + [" ".join(rng.choice(["cat", "dog's", "é.", "12"]) for _ in range(
        rng.choice([3, 50, 400, 1500, 4000]))) for _ in range(60)]
    rows = packing.pack(docs_of(texts, offset="clash", row=3), PATH, group_pieces=20).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(range(len(texts)))
    for i, t in enumerate(texts):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [2]
        at = 0
        for k, r in enumerate(sorted(by_doc[i], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at)
            assert r.length == 1024 or k == 0
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024


def test_pack_edges(docs_of):
    same = docs_of([(1, "x y", None, None, None)] * 7 + [(None, None, None, None, None)])
    got = packing.pack(same, PATH).collect()
    assert len(got) == 8 and len({r.sequence_id for r in got}) == 1
    assert packing.pack(same.limit(0), PATH).count() == 0
