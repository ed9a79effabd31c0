"""Components of links against a plain union-find."""

import random

import pytest

from prodsearch.llm import common


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)]
    edges += [(200 + i, 201 + i) for i in range(40)] + [(300, 301 + i) for i in range(30)]
    edges += [(None, 5), (7, 7), (900, 900)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    got = common.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.comp for r in got} == {x: root(x) for x in parent}


def test_no_links(spark):
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_gram_and_word_hashes():
    chunks = list(common.word_hash_chunks(["a b", None, "", "B a"], max_words=1))
    assert [i for i, _ in chunks] == [0, 1, 2, 3]
    assert chunks[0][1].tolist() == chunks[3][1][::-1].tolist() and not len(chunks[1][1])
    assert common.text_words("A\x0bb\x1cC é") == [b"a", b"b\x1cc", "é".encode()]
