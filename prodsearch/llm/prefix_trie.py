"""The trie of conversations' common beginnings, in balanced parentheses.

A node stands for a distinct sequence of first turns; its members are the
conversations that start with it. Turns travel as 20 bytes each (a 128-bit
hash of role and text, the text's size), never as texts.

1. Paths. A conversation's turns in order are its path; equal paths are
   counted before anything else, so copies cost one row.
2. Shards. Distinct paths are dealt by ranges of their order and cut into
   shards of about SHARD_TURNS turns. Sorted paths give a shard's part of the
   trie as balanced parentheses, a node's number being its place among the
   opening ones.
3. Answers. ``find_close`` delimits a node's subtree: blocks of BLOCK
   parentheses know their least excess, and a tree over the blocks skips to
   the one that closes. The rank of leaf pairs "()" counts leaves, cumulative
   arrays over node numbers give members and savings, a table of range minima
   the smallest member.
4. Spines. Two neighbouring shards share only the nodes on the common
   beginning of the last path of one and the first of the other. Each shard
   knows both lengths: it returns partial sums for these nodes (a shared node's
   own bytes, its link to its parent and its being a leaf are counted by one
   shard), which are added up by node.

Nothing is gathered per node but the ids of a digest, which are joined in
blocks of ID_BLOCK ids and then streamed in order. A conversation's path is
one value (20 bytes a turn).

Defined cases: null roles and texts are empty; turns are ordered null first,
equal turns by a hash of role and text (repeated rows are turns of their own);
rows without a conversation id belong to none and give nothing; an empty table gives
no nodes; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prodsearch.operators.guard import broadcast_if_small
from prodsearch.session import cut_lineage

TURN = 20                   # bytes of a turn: 16 of the hash, 4 of the text's size
SHARD_TURNS = 200_000
BLOCK = 64
ID_BLOCK = 4_096
NO_ID = np.iinfo(np.int64).max
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_code(role: Column, text: Column) -> Column:
    """40 hexadecimal digits: the md5 of role and text, the text's UTF-8 bytes."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.md5(both.cast("binary")), F.lpad(F.hex(F.octet_length(text).cast("long")), 8, "0"))


def conversation_turns(convs: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                       role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turn codes in order."""
    c, t = F.col(f"`{conv_id}`").cast("long"), F.col(f"`{turn}`")
    rows = convs.where(c.isNotNull()).select(
        c.alias("conv_id"), F.struct(t.isNotNull().alias("o"), t.alias("t"), turn_code(
            F.col(f"`{role}`"), F.col(f"`{text}`")).alias("e")).alias("x"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("x"))["e"].alias("turns"))


def with_borrowed_heads(convs: DataFrame) -> DataFrame:
    """(conv_id, turns), each conversation c rebuilt: the first h turns of
    conversation c - c % 5 (none if absent), then c's own after its first h;
    h = crc32 of the decimal id % 9."""
    c = F.col("conv_id")
    convs = cut_lineage(convs)
    own = convs.select("conv_id", "turns", (c - c % 5).alias("base"),
                       (F.crc32(c.cast("string").cast("binary")) % 9).cast("int").alias("h"))
    heads = convs.where(c % 5 == 0).select(c.alias("base"), F.slice("turns", 1, 8).alias("head"))
    none = F.array().cast("array<string>")
    return own.join(heads, "base", "left").select("conv_id", F.concat(
        F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
        F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


def id_digests(members: DataFrame, key: str, member: str) -> DataFrame:
    """(key, ends): the SHA-256 of each key's member ids, ascending, joined by
    commas. Ids are joined in blocks of ID_BLOCK numbers first; the blocks of
    a key are then streamed through its digest in order."""
    blocks = (members.groupBy(key, F.floor(F.col(member) / ID_BLOCK).alias("blk"))
              .agg(F.array_join(F.sort_array(F.collect_list(member)).cast("array<string>"), ",").alias("ids")))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sha = None, None
        for b in batches:
            keys, ends = [], []
            for k, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if k == at:
                    sha.update(b"," + ids.encode())
                    continue
                if at is not None:
                    keys.append(at)
                    ends.append(sha.hexdigest())
                at, sha = k, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(ends, pa.string())],
                                             [key, "ends"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([sha.hexdigest()])], [key, "ends"])

    return (blocks.repartition(key).sortWithinPartitions(key, "blk").select(key, "ids")
            .mapInArrow(digest, f"{key} string, ends string"))


def common_turns(a: bytes, b: bytes) -> int:
    """Number of first turns that two paths share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TURN
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(differ.argmax()) // TURN


class ExcessBlocks:
    """Balanced parentheses (+1, -1) with the least excess of each block of
    BLOCK of them, under a tree of minima."""

    def __init__(self, signs: np.ndarray):
        self.excess = np.cumsum(signs)
        blocks = -(-len(signs) // BLOCK)
        self.width = 1 << max(0, (blocks - 1).bit_length())
        padded = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        padded[:len(signs)] = self.excess
        self.tree = np.full(2 * self.width, np.iinfo(np.int64).max)
        self.tree[self.width:self.width + blocks] = padded.reshape(blocks, BLOCK).min(axis=1)
        row = self.width
        while row > 1:
            self.tree[row // 2:row] = np.minimum(self.tree[row:2 * row:2], self.tree[row + 1:2 * row:2])
            row //= 2

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """The place of the closing parenthesis of each opening one."""
        want = self.excess[opens] - 1
        out = np.full(len(opens), -1, np.int64)
        todo = self._scan(np.arange(len(opens)), opens + 1, want, out)
        if len(todo):
            node = opens[todo] // BLOCK + self.width
            target = want[todo]
            # climb to the first later part whose least excess is low enough, then down to its block
            up = np.arange(len(todo))
            while len(up):
                at = node[up]
                sibling = np.minimum(at + 1, len(self.tree) - 1)
                found = (at % 2 == 0) & (self.tree[sibling] <= target[up])
                node[up] = np.where(found, at + 1, at // 2)
                up = up[~found]
            while True:
                down = np.flatnonzero(node < self.width)
                if not len(down):
                    break
                left = 2 * node[down]
                node[down] = np.where(self.tree[left] <= target[down], left, left + 1)
            self._scan(todo, (node - self.width) * BLOCK, want, out)
        return out

    def _scan(self, which: np.ndarray, at: np.ndarray, want: np.ndarray, out: np.ndarray) -> np.ndarray:
        """Searches from ``at`` to the end of its block; returns those not found."""
        at = at.copy()
        end = np.minimum((at // BLOCK + 1) * BLOCK, len(self.excess))
        # a parenthesis that opens a block's last place has its block searched out
        missed = []
        live = at < end
        first_block = live | (at % BLOCK != 0)
        missed.append(which[~first_block])
        which, at, end = which[first_block], at[first_block], end[first_block]
        while len(which):
            hit = self.excess[at] == want[which]
            out[which[hit]] = at[hit]
            at = at + 1
            over = ~hit & (at >= end)
            missed.append(which[over])
            on = ~hit & ~over
            which, at, end = which[on], at[on], end[on]
        return np.sort(np.concatenate(missed))


def range_minima(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The minimum of values[i] up to values[i + size[i] - 1], for each i."""
    table = [values]
    while 1 << len(table) <= len(values):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    level = np.frexp(size.astype(np.float64))[1] - 1
    out = np.empty(len(values), values.dtype)
    for k in np.unique(level):
        i = np.flatnonzero(level == k)
        out[i] = np.minimum(table[k][i], table[k][i + size[i] - (1 << int(k))])
    return out


def _prefix_keys(path: bytes, depth: int) -> list[str]:
    """The names of the nodes of depth 0 to ``depth`` on a path."""
    h, out = hashlib.md5(), []
    for d in range(depth + 1):
        out.append(h.copy().hexdigest())
        h.update(path[d * TURN:(d + 1) * TURN])
    return out


FIELDS = [("key", pa.string()), ("parent_key", pa.string()), ("conv_id", pa.int64()), ("depth", pa.int64()),
          ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
          ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string())]


def shard_nodes(paths: list[bytes], counts: np.ndarray, least: np.ndarray, ends: list[str],
                before: int | None, after: int | None) -> pa.RecordBatch:
    """The nodes of a shard of sorted distinct paths. ``before`` and ``after``
    are the turns its first path shares with the path before the shard and its
    last with the path behind it (None: there is no such path). Nodes shared so
    carry a ``key`` and partial sums; a node below one carries ``parent_key``."""
    n_paths = len(paths)
    length = np.array([len(p) // TURN for p in paths], np.int64)
    shared = np.array([0] + [common_turns(a, b) for a, b in zip(paths, paths[1:])], np.int64)
    opens = length - shared
    closes = np.r_[0, length[:-1] - shared[1:]]
    last = np.cumsum(opens)                          # the node where each path ends
    n = 1 + int(last[-1])
    signs = np.concatenate([[1], np.tile([-1, 1], n_paths), [-1]]).repeat(
        np.concatenate([[1], np.stack([closes, opens], axis=1).ravel(), [length[-1] + 1]]))
    place = np.flatnonzero(signs > 0)
    close = ExcessBlocks(signs).find_close(place)
    size = (close - place + 1) // 2                  # nodes of each subtree

    depth = np.zeros(n, np.int64)
    depth[1:] = np.arange(n - 1) - np.repeat(last - opens, opens) + np.repeat(shared + 1, opens)
    tail = b"".join([p[s * TURN:] for p, s in zip(paths, shared.tolist())])
    nbytes = np.zeros(n, np.int64)
    nbytes[1:] = np.frombuffer(tail, np.uint8).reshape(-1, TURN)[:, 16:].copy().view(">u4").ravel()
    parent = np.arange(-1, n - 1)
    stack = [0]
    for s, z, o in zip(shared.tolist(), last.tolist(), opens.tolist()):
        if o:
            del stack[s + 1:]
            parent[z - o + 1] = stack[s]
            stack.extend(range(z - o + 1, z + 1))

    def subtree(values: np.ndarray) -> np.ndarray:
        c = np.r_[0, np.cumsum(values)]
        at = np.arange(n)
        return c[at + size] - c[at]

    ended = np.zeros(n, np.int64)
    ended[last] = counts
    low = np.full(n, NO_ID)
    low[last] = least
    end_sha = np.full(n, None, object)
    end_sha[last] = ends
    members = subtree(ended)
    fresh = np.ones(n, bool)                         # first seen in this shard
    fresh[:0 if before is None else before + 1] = False
    pair = np.r_[(signs[:-1] > 0) & (signs[1:] < 0), False]
    if after is not None and after == length[-1]:
        pair[place[last[-1]]] = False                # the next shard goes on below it
    rank = np.cumsum(pair)
    leaves = rank[close] - rank[place] + pair[place]
    saved = subtree(nbytes * (members - fresh))
    children = np.bincount(parent[1:][fresh[1:]], minlength=n)
    low = range_minima(low, size)

    key = np.full(n, None, object)
    if before is not None:
        key[:before + 1] = _prefix_keys(paths[0], before)
    if after is not None:
        key[stack[:after + 1]] = _prefix_keys(paths[-1], after)
    parent_key = np.where(parent >= 0, key[parent], None)
    parent_low = np.where((parent >= 0) & (parent_key == None), low[parent], -1)  # noqa: E711
    known = (parent >= 0) & (parent_key == None)     # noqa: E711
    values = [key, parent_key, low, depth, None, members, children, leaves, saved, end_sha]
    return pa.RecordBatch.from_arrays(
        [pa.array(parent_low, t, mask=~known) if v is None else pa.array(v, t) for v, (_, t) in zip(values, FIELDS)],
        [f for f, _ in FIELDS])


def _boundaries(rows: DataFrame) -> dict[int, tuple[int | None, int | None]]:
    """Per filled partition of the sorted paths: the turns its first path
    shares with the last one before it, and its last with the first one behind.
    Two numbers a partition come to the driver."""
    edge = rows.groupBy("pid").agg(F.min("path").alias("head"), F.max("path").alias("tail"))
    before = edge.select("pid", "head", F.lag("tail").over(Window.orderBy("pid")).alias("tail"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [None if z is None else common_turns(a, z) for a, z in zip(
                b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.int64())], ["pid", "k"])

    got = sorted((r.pid, r.k) for r in before.mapInArrow(measure, "pid int, k long").collect())
    follow = [k for _, k in got[1:]] + [None]
    return {pid: (k, nxt) for (pid, k), nxt in zip(got, follow)}


def trie_nodes(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of ``convs`` (conv_id, turns): conv_id (smallest
    member), depth, parent_conv_id (null at the root), n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256 (of the members that end there)."""
    path = F.unhex(F.array_join("turns", ""))
    members = cut_lineage(convs.select("conv_id", path.alias("path"), F.md5(path).alias("end")))
    distinct = members.groupBy("end", "path").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"))
    rows = cut_lineage(distinct.join(id_digests(members, "end", "conv_id"), "end")
                       .select("path", "n", "low", "ends"))
    rows = cut_lineage(rows.repartitionByRange("path").sortWithinPartitions("path"))
    rows = rows.withColumn("pid", F.spark_partition_id())
    shared = rows.sparkSession.sparkContext.broadcast(_boundaries(rows))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        turns, before, pid = 0, None, None

        def shard(after):
            p, c, low, ends = zip(*held)
            return shard_nodes(list(p), np.array(c, np.int64), np.array(low, np.int64), list(ends), before, after)

        for b in batches:
            for *row, pid_ in zip(*[c.to_pylist() for c in b.columns]):
                if pid is None:
                    pid = pid_
                    before = shared.value[pid][0]
                if turns >= shard_turns:
                    after = common_turns(held[-1][0], row[0])
                    yield shard(after)
                    held, turns, before = [], 0, after
                held.append(row)
                turns += len(row[0]) // TURN + 1
        if held:
            yield shard(shared.value[pid][1])

    kinds = {pa.string(): "string", pa.int64(): "long"}
    nodes = cut_lineage(rows.mapInArrow(shards, ", ".join(f"{n} {kinds[t]}" for n, t in FIELDS)))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    spine = cut_lineage(nodes.where("key IS NOT NULL").groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"), *sums, F.max("ends").alias("ends"))
        .select(*[f for f, _ in FIELDS]))
    # what a shard has to itself, below nodes of its own, is final
    whole = nodes.where("key IS NULL AND parent_key IS NULL")
    below = nodes.where("key IS NULL AND parent_key IS NOT NULL").unionByName(spine)
    named = spine.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("__low"))
    below = (below.join(broadcast_if_small(named, 1_000_000), "parent_key", "left")
             .withColumn("parent_conv_id", F.col("__low")).drop("__low"))
    return whole.unionByName(below).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(EMPTY_SHA)).alias("ends_sha256"))
