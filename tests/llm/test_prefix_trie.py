"""The prefix trie against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from prodsearch.llm import prefix_trie as P
from prodsearch.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_nodes(convs):
    """Nodes of {conv_id: tuple of (role, text)}."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = []
    for node, cs in members.items():
        sub = [x for x in members if x[:len(node)] == node]
        kids = [x for x in sub if len(x) == len(node) + 1]
        leaves = [x for x in sub if not any(y != x and y[:len(x)] == x for y in sub)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in sub if x)
        ended = sorted(c for c in cs if convs[c] == node)
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(kids),
                    len(leaves), saved, hashlib.sha256(",".join(map(str, ended)).encode()).hexdigest()))
    return sorted(out, key=str)


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, ())[:h] + turns[h:]
    return out


def read(rows):
    convs = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        convs[c] = convs.get(c, ()) + ((role or "", text or ""),)
    return convs


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_rows(rng, n):
    rows = []
    for c in rng.sample(range(4 * n), n):
        for t in range(rng.choice([1, 2, 3, 5, 9, 12])):
            rows.append((c, None if t == 0 and rng.random() < 0.3 else t, rng.choice(["u", "s", None]),
                         rng.choice(["", None, "a", "é"])))
    return rows


@pytest.mark.parametrize("shard", [1, 7, 100, 10**6])
def test_nodes_equal_brute_force(spark, shard):
    rng = random.Random(shard)
    rows = random_rows(rng, 60)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", depth int, path string")
    turns = P.conversation_turns(df.repartition(5))
    assert got(P.trie_nodes(turns, shard)) == brute_nodes(read(rows))
    assert got(P.trie_nodes(P.with_borrowed_heads(turns), shard)) == brute_nodes(rebuilt(read(rows)))


def test_deep_and_copied_conversations(spark):
    deep = [(1, t, "u", "x" * (t % 7)) for t in range(700)]
    rows = deep + [(2, t, "u", "x" * (t % 7)) for t in range(650)]
    rows += [(c, t, "u", "same") for c in range(10, 310) for t in range(3)]
    convs = read(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    found = {(r.conv_id, r.depth): r for r in P.trie_nodes(P.conversation_turns(df), 50).collect()}
    assert len(found) == 1 + 700 + 3
    root = found[1, 0]
    assert (root.parent_conv_id, root.n_convs, root.n_children, root.n_leaves) == (None, 302, 2, 2)
    size = [len(t[1]) for t in convs[1]]
    assert root.saved_tokens == sum(size[:650]) + 3 * 299 * 4
    assert found[1, 650].ends_sha256 == hashlib.sha256(b"2").hexdigest()
    assert (found[1, 650].n_convs, found[1, 651].n_convs, found[1, 651].saved_tokens) == (2, 1, 0)
    ids = ",".join(map(str, range(10, 310))).encode()
    assert found[10, 3].ends_sha256 == hashlib.sha256(ids).hexdigest()


def test_query_on_driver_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op13_prefix_trie(spark, sf)) == brute_nodes(rebuilt(read(rows)))


def test_edges(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert P.trie_nodes(P.with_borrowed_heads(P.conversation_turns(df))).count() == 0
    # rows without an id give nothing; repeated rows are turns of their own; equal turns have one order
    rows = [(None, 0, "u", "a"), (3, 0, "u", "a"), (3, 0, "u", "a"), (4, 1, "u", "b"), (4, 1, "s", "c"),
            (9, 1, "s", "c"), (9, 1, "u", "b")]
    found = got(P.trie_nodes(P.conversation_turns(spark.createDataFrame(rows, SCHEMA))))
    assert sorted((r[1], r[3]) for r in found) == [(0, 3), (1, 1), (1, 2), (2, 1), (2, 2)]


def test_all_turnless(spark):
    """Conversations that keep no turn are members of the root only."""
    rows = [(c, [0][:0], ) for c in range(3)]
    df = spark.createDataFrame([(c, []) for c, _ in rows], "conv_id long, turns array<string>")
    assert got(P.trie_nodes(df)) == [(0, 0, None, 3, 0, 1, 0, hashlib.sha256(b"0,1,2").hexdigest())]


def test_find_close():
    rng = np.random.default_rng(3)
    for _ in range(30):
        signs, depth = [], 0
        for _ in range(int(rng.integers(1, 400))):
            up = depth == 0 or rng.random() < rng.choice([0.2, 0.5, 0.8])
            signs.append(1 if up else -1)
            depth += signs[-1]
        signs = np.array([1] + signs + [-1] * (depth + 1))
        stack, want = [], {}
        for i, s in enumerate(signs.tolist()):
            if s > 0:
                stack.append(i)
            else:
                want[stack.pop()] = i
        opens = np.flatnonzero(signs > 0)
        assert P.ExcessBlocks(signs).find_close(opens).tolist() == [want[i] for i in opens.tolist()]
