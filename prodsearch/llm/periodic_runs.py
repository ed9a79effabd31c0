"""Maximal periodic runs of words, by recompression.

A run is a stretch of words with smallest period q that no neighbouring word
extends, of at least max(6, 4 q) words. Per batch of whole texts:

1. Candidates. A run with period q holds at least three neighbouring pairs of
   multiples of q (the harmonic grid: n / q points for each q), and every word
   between them equals the word q further on. Points that fail this at a few
   probed words can't lie in a run; the rest are candidates.
2. Grammar. The texts with candidates are compressed by recompression: each
   round first replaces every maximal block of one symbol by a symbol, then
   splits the symbols in two halves and replaces every pair of a left and a
   right one. Equal symbols of a round spell equal words, and the rounds form
   a run-length grammar in which equal stretches are parsed alike but for
   their ends.
3. Extension. How far two positions agree to the right and to the left is
   read off the grammar: climb while both stand at the edge of equal symbols,
   step over equal symbols (whole stretches of a block at once), and descend at a
   difference. The answers are exact. A candidate's extensions give the
   run, and the same queries tell whether a divisor of q is a period as well.

A text is never cut; texts are batched up to BATCH_WORDS words, so memory
follows that bound or the longest text.

Defined cases: null, empty and blank texts have no words and no runs; ties and
repeated rows are rows like any other; an empty table gives an empty table;
columns other than those named pass through unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodsearch.llm.common import mix64

MIN_WORDS = 6
MIN_PERIODS = 4
BATCH_WORDS = 200_000       # words of the texts that are worked on together


class Grammar:
    """Recompression of one string: ``levels`` rounds, each a block or a pair
    round. Level l's symbols are numbers; symbol k of level l + 1 stands for
    the symbols ``first[l + 1][k]`` up to ``first[l + 1][k + 1]`` of level l.
    Symbols below 0 are separators, which differ from all others and are
    never joined with anything."""

    def __init__(self, symbols: np.ndarray):
        sym = symbols.astype(np.int64)
        self.syms, self.first, self.parent, self.blocks = [sym], [None], [], []
        pos = np.arange(len(sym) + 1)
        self.pos = [pos]
        seps = int((sym < 0).sum())
        stuck, salt = False, 0
        while len(sym) > 2 * seps + 1 or not stuck:
            starts = np.flatnonzero(np.r_[True, (sym[1:] != sym[:-1])]) if len(sym) else np.empty(0, np.int64)
            sym = self._level(sym, starts, True)
            salt += 1
            starts = self._pairs(sym, salt)
            stuck = len(starts) == len(sym) and not self._joinable(sym)
            if len(starts) < len(sym):
                sym = self._level(sym, starts, False)
            if stuck:
                break
        for of in ("syms", "first", "parent", "pos"):
            setattr(self, of, [None if a is None else memoryview(np.ascontiguousarray(a)) for a in getattr(self, of)])

    @staticmethod
    def _joinable(sym: np.ndarray) -> bool:
        return bool(((sym[1:] >= 0) & (sym[:-1] >= 0)).any())

    @staticmethod
    def _pairs(sym: np.ndarray, salt: int) -> np.ndarray:
        """First symbols of the groups of a pair round: a left symbol and the
        right one behind it are a group. Halves by a hash of the symbol, in
        the order that joins more."""
        with np.errstate(over="ignore"):
            side = (mix64(sym.astype(np.uint64) + np.uint64(salt << 40)) >> np.uint64(17)) & np.uint64(1) == 1
        real = sym >= 0
        both = real[1:] & real[:-1]
        ways = [both & side[:-1] & ~side[1:], both & ~side[:-1] & side[1:]]
        joined = max(ways, key=lambda w: int(w.sum()))
        return np.flatnonzero(np.r_[True, ~joined]) if len(sym) else np.empty(0, np.int64)

    def _level(self, sym: np.ndarray, starts: np.ndarray, block: bool) -> np.ndarray:
        """Adds the level whose symbols start at ``starts`` and names them."""
        first = np.r_[starts, len(sym)]
        size = np.diff(first)
        head = sym[starts]
        # a block is its letter and length, a pair its two symbols
        tail = size if block else np.where(size == 2, sym[np.minimum(starts + 1, len(sym) - 1)] + 1, 0)
        low = int(head.min()) if len(head) else 0
        width = int(tail.max()) + 1 if len(tail) else 1
        if (int(head.max()) - low + 1 if len(head) else 1) * width < 1 << 62:
            _, name = np.unique((head - low) * width + tail, return_inverse=True)
        else:
            _, name = np.unique(np.stack([head, tail]), axis=1, return_inverse=True)
        new = np.where(head < 0, head, name.reshape(-1))
        self.parent.append(np.repeat(np.arange(len(starts)), size))
        self.first.append(first)
        self.blocks.append(block)
        self.syms.append(new)
        self.pos.append(self.pos[-1][first])
        return new

    def right(self, i: int, j: int) -> int:
        """Number of equal words from positions i < j on."""
        syms, first, parent, pos, blocks = self.syms, self.first, self.parent, self.pos, self.blocks
        level, p, q, top, n = 0, i, j, len(blocks), len(syms[0])
        if j >= n:
            return 0
        while True:
            # climb while both start equal symbols
            while level < top:
                a, b = parent[level][p], parent[level][q]
                up = level + 1
                if first[up][a] != p or first[up][b] != q or syms[up][a] != syms[up][b]:
                    break
                level, p, q = up, a, b
            row = syms[level]
            if row[p] == row[q]:
                step = 1
                if level < top and blocks[level]:
                    edge = first[level + 1]
                    step = min(edge[parent[level][p] + 1] - p, edge[parent[level][q] + 1] - q)
                p, q = p + step, q + step
                if q >= len(row):
                    return n - j
            elif level == 0:
                return p - i
            else:
                p, q = first[level][p], first[level][q]
                level -= 1

    def left(self, i: int, j: int) -> int:
        """Number of equal words that end right before positions i < j."""
        syms, first, parent, blocks = self.syms, self.first, self.parent, self.blocks
        level, p, q, top = 0, i - 1, j - 1, len(blocks)
        if p < 0:
            return 0
        while True:
            while level < top:
                a, b = parent[level][p], parent[level][q]
                up = level + 1
                if first[up][a + 1] != p + 1 or first[up][b + 1] != q + 1 or syms[up][a] != syms[up][b]:
                    break
                level, p, q = up, a, b
            row = syms[level]
            if row[p] == row[q]:
                step = 1
                if level < top and blocks[level]:
                    edge = first[level + 1]
                    step = min(p - edge[parent[level][p]], q - edge[parent[level][q]]) + 1
                p, q = p - step, q - step
                if p < 0:
                    return i
            elif level == 0:
                return i - 1 - p
            else:
                p, q = first[level][p + 1] - 1, first[level][q + 1] - 1
                level -= 1


def candidates(sym: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(q, points): multiples x of q such that the words of x, x + q and
    x + 2 q equal the words q further on, and so do some words between."""
    n = len(sym)
    for q in range(1, longest // MIN_PERIODS + 1):
        grid = sym[::q]
        same = grid[1:] == grid[:-1]
        if len(same) < 3:
            return
        at = np.flatnonzero(same[2:] & same[1:-1] & same[:-2]) * q
        for probe in dict.fromkeys((1, q - 1, q // 2, q + q // 2, q // 3, 2 * q - 1)):
            if not len(at):
                break
            at = at[sym[at + probe] == sym[at + probe + q]]
        if len(at):
            yield q, at


def prime_divisors(q: int) -> list[int]:
    out, d = [], 2
    while d * d <= q:
        if q % d == 0:
            out.append(d)
            while q % d == 0:
                q //= d
        d += 1
    return out + [q] if q > 1 else out


def runs_of(sym: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a string of symbols in which
    separators (below 0, all different) stand between texts of at most
    ``longest`` words; by period, then start."""
    found = list(candidates(sym, longest))
    if not found:
        return []
    # only texts with candidates need a grammar
    ends = np.flatnonzero(sym < 0)
    hit = np.unique(np.searchsorted(ends, np.concatenate([at for _, at in found])))
    text_of = np.searchsorted(ends, np.arange(len(sym)))
    keep = np.isin(text_of, hit)
    to = np.cumsum(keep) - 1
    back = np.flatnonzero(keep)
    g = Grammar(sym[keep])
    out = []
    for q, at in found:
        done = -1
        primes = prime_divisors(q)
        for x in to[at].tolist():
            if x <= done:
                continue
            right = g.right(x, x + q)
            start = x - g.left(x, x + q)
            length = x + q + right - start
            if length < max(MIN_WORDS, MIN_PERIODS * q):
                continue
            # another run of this period starts less than q before this one's end
            done = start + length - q
            if not any(g.right(start, start + q // r) >= length - q // r for r in primes):
                out.append((int(back[start]), length, q))
    return out


def text_runs(words: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, by start, then period."""
    ids: dict[bytes, int] = {}
    number = ids.setdefault
    sym = []
    for k, w in enumerate(words):
        sym.extend([number(x, len(ids)) for x in w])
        sym.append(-1 - k)
    sizes = np.array([len(w) for w in words], np.int64)
    begin = np.r_[0, np.cumsum(sizes + 1)]
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for s, length, q in runs_of(np.array(sym, np.int64), int(sizes.max(initial=0))):
        k = int(np.searchsorted(begin, s, side="right")) - 1
        out[k].append((s - int(begin[k]), length, q))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by spaces."""
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, np.int64)
    for s, length, q in runs:
        drop[s + q] += 1
        drop[s + length] -= 1
    return b" ".join([w for w, d in zip(words, np.cumsum(drop).tolist()) if not d])


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, runs (start, length, period; by start,
    then period) and collapsed, the text's words without the repetitions of
    its runs, joined by one space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, size, at = [], 0, 0
            texts = b.column(1)
            for k in range(b.num_rows):
                t = texts[k].as_py()
                held.append(t.encode("utf-8", "surrogatepass").split() if t else [])
                size += len(held[-1])
                if size >= BATCH_WORDS or k == b.num_rows - 1:
                    runs = text_runs(held)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(at, len(held)),
                         pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs], _RUNS),
                         pa.array([collapsed(w, r).decode("utf-8", "surrogatepass") for w, r in zip(held, runs)],
                                  pa.string())], ["doc_id", "runs", "collapsed"])
                    held, size, at = [], 0, k + 1

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(
        run, f"doc_id {kind}, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def with_planted_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every tenth text, by h = crc32 of its decimal id, made
    periodic from word a = g % n on (g = h / 10, n words): word i becomes word
    a + (i - a) % p, p = 1 + (n - a) / (3 + g % 8). Rows without an id or
    words stay as they are."""
    from prodsearch.llm.common import let, word_array

    h = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def rebuild(words):
        n = F.size(words).cast("long")

        def from_word(a):
            p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
            return let(p, lambda p: F.array_join(F.transform(
                words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int")))), " "))
        return F.when(n > 0, let(g % F.greatest(n, F.lit(1)), from_word))

    made = let(word_array(F.col(f"`{text}`")), rebuild)
    return docs.withColumn(text, F.when(h % 10 == 0, F.coalesce(made, F.col(f"`{text}`")))
                           .otherwise(F.col(f"`{text}`")))
