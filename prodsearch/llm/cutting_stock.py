"""Packing by cutting-stock column generation.

Documents are tokenized and cut into full sequences and a rest, whose length
is below a sequence's. Sequences are padded to ``capacity``, except where
their length is a power of two. The rests are planned from the histogram of their
lengths alone:

1. A linear program over patterns (multisets of lengths that fit a sequence)
   uses every rest once and minimizes padding. Its columns are generated: the
   duals price lengths, and a knapsack dynamic program over all totals finds the
   patterns worth adding; a revised simplex takes them in, starting from a
   greedy basis of patterns that use up one length each.
2. Pattern counts are rounded down, then up by fraction while rests are left.
   What remains (at most a pattern for each length) is packed best-fit
   decreasing.
3. Documents are ranked by length: rank r of a length takes the place that the
   plan gives to its r-th rest. The plan holds a few numbers a pattern, so
   it is small whatever the table.
4. Copies of a pattern that would be padded by more than MAX_PAD tokens are laid end to
   end, RUN_COPIES at a time, and cut at sequence ends; a run's last part is cut
   into powers of two. The documents cut there, and only they, are tokenized again.

Lengths are all that is shuffled. The histogram (below ``capacity`` rows) is what the
driver sees; ranks come from counts by task and length, so that a hot
length is never in one task.

Defined cases: a null or empty text is one piece holding the end id; a null
id is an id like any other; repeated rows are packed once each; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prodsearch.llm.common import give_back, map_texts, parts_of
from prodsearch.llm.packing import best_fit_decreasing
from prodsearch.llm.pretokens import encoder
from prodsearch.operators.guard import broadcast_if_small
from prodsearch.session import cut_lineage

CAPACITY = 1024
END_ID = 0
MAX_PAD = 4                 # tokens a sequence may be padded by rather than cut
RUN_COPIES = 16
MAX_PIVOTS = 600            # of the simplex; any basis is a whole plan
COLUMNS_A_ROUND = 40
PAD_SHARE = 1e-4            # padding of all rests' tokens that is good enough
EPS = 1e-7
REFRESH = 200               # pivots after which the duals are computed anew


def padding(totals: np.ndarray, capacity: int) -> np.ndarray:
    """Padding of sequences with these numbers of tokens."""
    return np.where(totals & (totals - 1) == 0, 0, capacity - totals)


def knapsack(lengths: np.ndarray, value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(best, item): the greatest value of a multiset of ascending ``lengths``
    for each total, and the number of a length in it (-1: no such total)."""
    best = np.full(capacity + 1, -np.inf)
    item = np.full(capacity + 1, -1)
    best[0] = 0
    many = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for total in range(int(lengths[0]), capacity + 1):
        m = many[total]
        got = best[total - lengths[:m]] + value[:m]
        k = int(got.argmax())
        if got[k] > -np.inf:
            best[total], item[total] = got[k], k
    return best, item


def greedy_basis(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(number of a length, pattern) for each length, in an order in which no
    later pattern holds a length named before: each uses one length up. The
    longest rest is filled up exactly by one or two others where possible, else
    by the longest that fit."""
    left = np.zeros(capacity + 1)
    left[lengths] = counts
    number = {int(x): k for k, x in enumerate(lengths)}
    open_ = np.zeros(capacity + 1, bool)
    open_[lengths] = True
    basis: list[tuple[int, dict[int, int]]] = []
    while open_.any():
        big = int(np.flatnonzero(open_)[-1])
        items, room = [big], capacity - big
        if room and open_[room]:
            items.append(room)
        elif room:
            j = np.flatnonzero(open_[1:room]) + 1
            j = j[open_[room - j]]
            if len(j):
                items += [int(j[-1]), room - int(j[-1])]
            else:
                while room:
                    fits = np.flatnonzero(open_[1:room + 1])
                    if not len(fits):
                        break
                    items.append(int(fits[-1]) + 1)
                    room -= items[-1]
        pattern: dict[int, int] = {}
        for x in items:
            pattern[x] = pattern.get(x, 0) + 1
        use = min(left[x] / a for x, a in pattern.items())
        spent = min(pattern, key=lambda x: (left[x] / pattern[x], -x))
        for x, a in pattern.items():
            left[x] = max(0.0, left[x] - use * a)
        left[spent] = 0
        open_[spent] = False
        basis.append((number[spent], {number[x]: a for x, a in pattern.items()}))
    return basis


def generate_columns(lengths: np.ndarray, counts: np.ndarray, capacity: int = CAPACITY,
                     max_pivots: int = MAX_PIVOTS) -> tuple[list[dict[int, int]], np.ndarray]:
    """(patterns, uses): a basic solution of the linear program. A pattern maps
    the number of a length to how often it holds it; uses are fractional."""
    m = len(lengths)
    totals = np.arange(capacity + 1)
    price = 1.0 + padding(totals, capacity)          # a sequence, and its padding
    price[0] = np.inf
    # numpy's own loops throughout: its linear algebra starts threads, which may
    # lock up in a driver that has forked
    patterns: list[dict[int, int]] = [{} for _ in range(m)]
    inverse = np.eye(m)
    for k, p in greedy_basis(lengths, counts, capacity):
        patterns[k] = p
        step = np.zeros(m)
        step[list(p)] = list(p.values())
        _pivot(inverse, step, k)
    cost = np.array([price[sum(int(lengths[i]) * a for i, a in p.items())] for p in patterns])
    uses = np.maximum((inverse * counts).sum(axis=1), 0.0)
    enough = PAD_SHARE * float((lengths * counts).sum())
    pivots = 0
    duals = _product(cost, inverse)
    while pivots < max_pivots and ((cost - 1) * uses).sum() > enough:
        best, item = knapsack(lengths, duals, capacity)
        # the best pattern of each total, and the best full one with each length
        with_each = duals + best[capacity - lengths]
        found = [(price[t] - best[t], t, -1) for t in np.flatnonzero(price - best < -EPS).tolist()]
        found += [(price[capacity] - with_each[i], capacity, i)
                  for i in np.flatnonzero(price[capacity] - with_each < -EPS).tolist()]
        if not found:
            break
        before = pivots
        for _, total, i in sorted(found)[:COLUMNS_A_ROUND]:
            pattern: dict[int, int] = {}
            room = total
            if i >= 0:
                pattern[i] = 1
                room -= int(lengths[i])
            while room:
                k = int(item[room])
                pattern[k] = pattern.get(k, 0) + 1
                room -= int(lengths[k])
            rows, held = list(pattern), np.array(list(pattern.values()), np.float64)
            gain = price[total] - (duals[rows] * held).sum()
            if gain > -EPS:
                continue                             # an earlier column of this round did its work
            step = (inverse[:, rows] * held).sum(axis=1)
            up = np.flatnonzero(step > 1e-9)
            ratio = uses[up] / step[up]
            # of equal ratios the largest step, for a stable inverse
            near = up[ratio <= ratio.min() + 1e-12]
            out = int(near[step[near].argmax()])
            theta = uses[out] / step[out]
            _pivot(inverse, step, out)
            duals = duals + gain * inverse[out]
            step[out] = 0.0
            uses = np.maximum(uses - theta * step, 0.0)
            uses[out] = theta
            patterns[out], cost[out] = pattern, price[total]
            pivots += 1
            if pivots % REFRESH == 0:
                duals = _product(cost, inverse)
        if pivots == before:
            break
    return patterns, uses


def _product(v: np.ndarray, m: np.ndarray) -> np.ndarray:
    rows = np.flatnonzero(v)
    return (v[rows, None] * m[rows]).sum(axis=0)


def _pivot(inverse: np.ndarray, step: np.ndarray, out: int) -> None:
    """The inverse of a basis whose column ``out`` becomes another, which is
    ``step`` in terms of the old basis; most of both is zero."""
    row = inverse[out] / step[out]
    i, j = np.flatnonzero(np.abs(step) > 1e-13), np.flatnonzero(np.abs(row) > 1e-13)
    if 3 * len(j) < len(row):
        inverse[np.ix_(i, j)] -= step[i, None] * row[j]
    else:
        inverse[i] -= step[i, None] * row
    inverse[out] = row


def round_uses(patterns: list[dict[int, int]], uses: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whole uses, rests left over of each length)."""
    whole = np.floor(uses + 1e-6).astype(np.int64)
    left = counts.astype(np.int64).copy()
    for j in np.argsort(-whole, kind="stable").tolist():
        rows, held = list(patterns[j]), np.array(list(patterns[j].values()))
        whole[j] = max(0, min(int(whole[j]), int((left[rows] // held).min())))
        left[rows] -= whole[j] * held
    for j in np.argsort(-(uses - whole), kind="stable").tolist():
        rows, held = list(patterns[j]), np.array(list(patterns[j].values()))
        if uses[j] > whole[j] and (left[rows] >= held).all():
            whole[j] += 1
            left[rows] -= held
    return whole, left


def chop(tokens: int, capacity: int, max_pad: int = MAX_PAD) -> list[int]:
    """Lengths of the sequences that a run of tokens is cut into: full ones,
    then its last part, as one sequence if it needs no or little padding, else in powers of two."""
    out, rest = [capacity] * (tokens // capacity), tokens % capacity
    if rest and capacity - rest <= max_pad:
        return [*out, rest]
    return out + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


class Plan(NamedTuple):
    """Where the rests of each length go. Entry e holds the ranks of one
    length from ``low`` on (``key`` joins length and low, ascending): ``each``
    rests stand one after the other at ``at`` in a pattern of ``total`` tokens;
    ``copies`` patterns are laid in runs of ``run``, whose sequences count from ``seq``."""

    capacity: int
    key: np.ndarray
    low: np.ndarray
    each: np.ndarray
    at: np.ndarray
    total: np.ndarray
    copies: np.ndarray
    run: np.ndarray
    seq: np.ndarray
    sequences: int


_RANK_BITS = 44


def make_plan(histogram: dict[int, int], capacity: int = CAPACITY, max_pivots: int = MAX_PIVOTS) -> Plan:
    """The plan for this many rests of each length (below ``capacity``)."""
    lengths = np.array(sorted(k for k, n in histogram.items() if n), np.int64)
    counts = np.array([histogram[int(k)] for k in lengths], np.float64)
    rows: list[tuple] = []
    taken = dict.fromkeys(lengths.tolist(), 0)
    seq = 0

    def lay(items: list[tuple[int, int]], copies: int) -> None:
        """``copies`` patterns of (length, number) parts."""
        nonlocal seq
        total = sum(x * a for x, a in items)
        pad = 0 if total & (total - 1) == 0 else max(0, capacity - total)
        run = 1 if total > capacity or pad <= MAX_PAD else min(RUN_COPIES, copies)
        at = 0
        for x, a in items:
            rows.append(((x << _RANK_BITS) + taken[x], taken[x], a, at, total, copies, run, seq))
            taken[x] += a * copies
            at += x * a
        full_runs, rest = divmod(copies, run)
        seq += full_runs * len(chop(run * total, capacity)) + (len(chop(rest * total, capacity)) if rest else 0)

    if len(lengths):
        patterns, uses = generate_columns(lengths, counts, capacity, max_pivots)
        whole, left = round_uses(patterns, uses, counts)
        for p, n in zip(patterns, whole.tolist()):
            if n:
                lay([(int(lengths[i]), a) for i, a in sorted(p.items(), reverse=True)], n)
        over = np.repeat(lengths, left)
        bins, _ = best_fit_decreasing(over, capacity)
        order = np.argsort(bins, kind="stable")
        run: list[tuple[int, int]] = []
        for held in np.split(over[order], np.flatnonzero(np.diff(bins[order])) + 1) if len(over) else []:
            parts = [(int(x), int(n)) for x, n in zip(*np.unique(held, return_counts=True))][::-1]
            total = int(held.sum())
            if capacity - total <= MAX_PAD or total & (total - 1) == 0:
                lay(parts, 1)
            else:
                run += parts
        if run:                                      # the sequences not filled, as one run
            lay(run, 1)
    rows.sort()
    table = np.array(rows, np.int64).reshape(len(rows), 8)
    return Plan(capacity, *table.T.copy(), seq)


def place(plan: Plan, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, skipped, length, sequence, offset, cut) of the pieces of these
    rests: ``skipped`` tokens of the rest come before a piece."""
    e = np.searchsorted(plan.key, (length << _RANK_BITS) + rank, side="right") - 1
    k = rank - plan.low[e]
    each, total, run = plan.each[e], plan.total[e], plan.run[e]
    copy = k // each
    r = copy // run
    here = np.minimum(run, plan.copies[e] - r * run) * total         # tokens of this run
    at = (copy % run) * total + plan.at[e] + (k % each) * length
    parts_a_run = _parts(plan.capacity)
    seq = plan.seq[e] + r * np.array([parts_a_run(n) for n in (run * total).tolist()], np.int64)
    full = here // plan.capacity * plan.capacity
    easy = (at + length <= full) & (at // plan.capacity == (at + length - 1) // plan.capacity)
    rows = [np.flatnonzero(easy)]
    whole = [np.stack([np.zeros(len(rows[0]), np.int64), length[easy], seq[easy] + at[easy] // plan.capacity,
                       at[easy] % plan.capacity, np.zeros(len(rows[0]), np.int64)])]
    hard = np.flatnonzero(~easy)
    at_row, parts = [], []
    for i in hard.tolist():
        ends = _ends(int(here[i]), plan.capacity)
        a, z = int(at[i]), int(at[i] + length[i])
        s = int(np.searchsorted(ends, a, side="right"))
        cut = int(z > ends[s])
        while a < z:
            begin = int(ends[s - 1]) if s else 0
            b = min(z, int(ends[s]))
            at_row.append(i)
            parts.append((a - int(at[i]), b - a, int(seq[i]) + s, a - begin, cut))
            a, s = b, s + 1
    rows.append(np.array(at_row, np.int64))
    whole.append(np.array(parts, np.int64).reshape(-1, 5).T)
    return np.concatenate(rows), *np.concatenate(whole, axis=1)


@lru_cache(maxsize=4096)
def _ends(tokens: int, capacity: int) -> np.ndarray:
    return np.cumsum(chop(tokens, capacity))


def _parts(capacity: int):
    return lambda tokens: len(_ends(tokens, capacity))


def rests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
          capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, thash, start, length, ids_crc32, doc_tokens, task, rank): each
    row of ``docs`` tokenized, ended by ``end_id`` and cut into full pieces and
    a rest; ``rank`` counts a task's rests of one length."""
    end = np.array([end_id], "<u4").tobytes()

    def make():
        e, task = encoder(path), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)

        def cut(texts: pa.Array) -> dict:
            out = {c: [] for c in ("at", "start", "length", "ids_crc32", "doc_tokens", "task", "rank")}
            for i, ids in enumerate(e.column_ids(texts)):
                ids += end
                total = len(ids) // 4
                for s in range(0, total, capacity):
                    n = min(capacity, total - s)
                    for c, v in zip(out, (i, s, n, zlib.crc32(ids[4 * s:4 * (s + n)]), total, task, seen[n])):
                        out[c].append(v)
                    seen[n] += 1
            return out
        return cut

    t = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(t).alias("thash"), t.alias("text"))
    return map_texts(rows, ["doc_id", "thash"], "text", make,
                     {"start": "long", "length": "long", "ids_crc32": "long", "doc_tokens": "long",
                      "task": "int", "rank": "long"}, keeps_state=True, arrow=True)


def pack(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """Every piece (doc_id, start, length, ids_crc32, doc_tokens) with its
    ``sequence_id`` and its ``offset`` there."""
    pieces = cut_lineage(rests(docs, path, doc_id, text, capacity, end_id))
    short = pieces.where(F.col("length") < capacity)
    # ranks over all tasks: a task's own, after those of the tasks before it
    by_task = cut_lineage(short.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")))
    histogram = {r.length: int(r.n) for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = docs.sparkSession.sparkContext.broadcast(make_plan(histogram, capacity, max_pivots))
    before = by_task.select("length", "task", (F.sum("n").over(
        Window.partitionBy("length").orderBy("task")) - F.col("n")).alias("before"))
    ranked = (short.join(before, ["length", "task"])
              .select("doc_id", "thash", "start", "length", "ids_crc32", "doc_tokens",
                      (F.col("rank") + F.col("before")).alias("rank")))
    kind = docs.schema[doc_id].dataType.simpleString()
    columns = ["doc_id", "thash", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in columns[1:])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()                 # the tokenizer of the tasks before
        for b in batches:
            if not b.num_rows:
                continue
            col = {n: b.column(n) for n in ("start", "length", "ids_crc32", "rank")}
            row, skipped, length, seq, offset, cut = place(plan.value, col["length"].to_numpy(), col["rank"].to_numpy())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(row)), b.column("thash").take(pa.array(row)),
                 pa.array(col["start"].to_numpy()[row] + skipped), pa.array(length),
                 pa.array(col["ids_crc32"].to_numpy()[row], mask=cut > 0),
                 b.column("doc_tokens").take(pa.array(row)), pa.array(seq), pa.array(offset)], columns)

    placed = ranked.mapInArrow(assign, schema)
    full = (pieces.where(F.col("length") >= capacity)
            .withColumn("sequence_id", -1 - F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("long")).select(*columns))
    cut = cut_lineage(placed.where("ids_crc32 IS NULL"))
    return (full.unionByName(placed.where("ids_crc32 IS NOT NULL"))
            .unionByName(_with_ids(cut, docs, path, doc_id, text, end_id, schema)).drop("thash"))


def _with_ids(cut: DataFrame, docs: DataFrame, path: str, doc_id: str, text: str, end_id: int,
              schema: str) -> DataFrame:
    """The cut pieces with their ids' checksums, from their documents' texts."""
    end = np.array([end_id], "<u4").tobytes()
    t = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{doc_id}`").alias("__id"), F.xxhash64(t).alias("__th"), t.alias("__text"))
    keys = cut.select("doc_id", "thash").distinct()
    same = (F.col("__th") == F.col("thash")) & F.col("__id").eqNullSafe(F.col("doc_id"))
    texts = (rows.join(broadcast_if_small(keys, 1_000_000), same, "left_semi")
             .dropDuplicates(["__id", "__th"]))
    joined = cut.join(texts, same).select("__text", *cut.columns)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (p for whole in batches for p in parts_of(whole, 0)):
            e = encoder(path)
            got, last, ids = [], object(), b""
            for s, start, n in zip(b.column(0).to_pylist(), b.column("start").to_pylist(),
                                   b.column("length").to_pylist()):
                if s is not last:
                    last, ids = s, e.ids(s) + end
                got.append(zlib.crc32(ids[4 * start:4 * (start + n)]))
            held = {c: b.column(c) for c in b.schema.names[1:]}
            held["ids_crc32"] = pa.array(got, pa.int64())
            yield pa.RecordBatch.from_arrays(list(held.values()), list(held))

    return joined.mapInArrow(fill, schema)
