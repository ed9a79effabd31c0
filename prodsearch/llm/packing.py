"""Best-fit packing of tokenized documents into sequences of fixed capacity.

Documents longer than a sequence are cut into full pieces (only the first
piece may be shorter), full pieces are sequences of their own, and the rest
is packed best-fit decreasing: a segment tree over the remaining capacities
finds the tightest open sequence in logarithmic time per piece. Pieces are
spread over groups of bounded size by a hash, so no task holds more than a
group, and only lengths are shuffled, never ids.

Defined cases: a null or empty text is one piece holding the end id; a null
id is an id like any other; repeated rows are packed once each; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodsearch.llm.common import map_texts
from prodsearch.llm.pretokens import encoder
from prodsearch.session import cut_lineage

CAPACITY = 1024
END_ID = 2
GROUP_PIECES = 20_000       # expected pieces packed together by one task
_GROUP_STRIDE = 1 << 32     # sequence numbers per group


class OpenBins:
    """Open sequences by remaining capacity, under a segment tree whose leaf
    ``r`` counts the open sequences with ``r`` left."""

    def __init__(self, capacity: int):
        self.width = 1
        while self.width < capacity + 1:
            self.width *= 2
        self.tree = [0] * (2 * self.width)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def push(self, left: int, bin_id: int) -> None:
        self.bins[left].append(bin_id)
        self._add(left, 1)

    def pop_tightest(self, need: int) -> tuple[int, int] | None:
        """(remaining capacity, sequence) of the fullest open sequence that
        still holds ``need``; it is taken out."""
        node, tree = need + self.width, self.tree
        if not tree[node]:
            # climb until a right sibling holds an open sequence, then go down left first
            while True:
                if node == 1:
                    return None
                if node % 2 == 0 and tree[node + 1]:
                    node += 1
                    break
                node //= 2
            while node < self.width:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        left = node - self.width
        self._add(left, -1)
        return left, self.bins[left].pop()

    def _add(self, left: int, by: int) -> None:
        node = left + self.width
        while node:
            self.tree[node] += by
            node //= 2


def best_fit_decreasing(lengths, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, placing the longest first."""
    lengths = np.asarray(lengths, dtype=np.int64)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins, n = OpenBins(capacity), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = open_bins.pop_tightest(need)
        left, b = found if found else (capacity, n)
        n += found is None
        bins[i], offsets[i] = b, capacity - left
        if left > need:
            open_bins.push(left - need, b)
    return bins, offsets


def token_pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, row, piece, start, length, ids_crc32): each row of ``docs``
    tokenized, ended by ``end_id`` and cut into pieces. ``row`` tells repeated
    rows apart."""
    end = np.array([end_id], "<u4").tobytes()

    def make():
        e = encoder(path)

        def cut(texts: pa.Array) -> dict:
            out = {c: [] for c in ("at", "piece", "start", "length", "ids_crc32")}
            for i, ids in enumerate(e.column_ids(texts)):
                ids += end
                total = len(ids) // 4
                edges = [0, *range(total % capacity or capacity, total + 1, capacity)]
                for k, (s, z) in enumerate(zip(edges, edges[1:])):
                    for c, v in zip(out, (i, k, s, z - s, zlib.crc32(ids[4 * s:4 * z]))):
                        out[c].append(v)
            return out
        return cut

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       F.col(text).alias("text"))
    return map_texts(rows, ["doc_id", "row"], "text", make,
                     {"piece": "int", "start": "long", "length": "long", "ids_crc32": "long"},
                     keeps_state=True, arrow=True)


def pack(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Every piece with its ``sequence_id`` and its ``offset`` there."""
    pieces = cut_lineage(token_pieces(docs, path, doc_id, text, capacity, end_id))
    short = pieces.where(F.col("length") < capacity)
    groups = max(1, -(-short.count() // group_pieces))
    # a sequence of its own for each full piece: odd stride, apart from the groups'
    full = (pieces.where(F.col("length") >= capacity)
            .withColumn("sequence_id", -1 - F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("long")))
    spread = short.withColumn("grp", F.pmod(F.xxhash64("doc_id", "row", "piece"), F.lit(groups)))

    def place(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("row", "ascending"), ("piece", "ascending")])
        bins, offsets = best_fit_decreasing(group["length"].to_numpy(), capacity)
        base = group["grp"][0].as_py() * _GROUP_STRIDE
        return (group.drop_columns("grp").append_column("sequence_id", pa.array(base + bins))
                .append_column("offset", pa.array(offsets)))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    packed = spread.groupBy("grp").applyInArrow(place, f"{fields}, sequence_id long, offset long")
    return packed.unionByName(full).drop("row")
