"""Language-model scoring by a Brown class-based bigram model.

Exchange clustering assigns words to classes; a text's probability is the
product of smoothed class transitions and word emissions. What it learns from
covers every training document: counts of all words, and bigram counts of
units. A unit is one of the most frequent words or, for the others, the
group of their last letters, so that every word has a class. The exchange
runs on the unit bigrams, whose number is bounded by the parameters alone.

Counts of all words stay distributed. The most frequent ones are
broadcast (a bounded table); a text's other words are joined with the counts
by a 64-bit hash (two of a billion words collide with a chance of 3 %).

Defined cases: a null or empty text is one end token; a null id belongs to
the training fold; repeated rows count and score each; an empty table gives
an empty table, and without training documents every token is unknown; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodsearch.llm.common import map_texts, mix64, text_words
from prodsearch.session import cut_lineage

EXCHANGE_ROUNDS = 8
TRANSITION_PRIOR = 2.0      # smoothing weight of a class's overall share
CHUNK_WORDS = 400_000       # words hashed together

END_HASH = np.uint64(0)     # stands for the end token; no word is mapped to it
_END_UNIT = 0


@dataclass(frozen=True)
class Sizes:
    """Bounds of the model, whatever the corpus."""

    head: int = 2_048           # words that are units of their own
    endings: int = 512          # groups of the other words, by their last three bytes
    classes: int = 64
    known: int = 1 << 18        # words whose counts are broadcast: 4 MB

    @property
    def units(self) -> int:
        return 1 + self.head + self.endings


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Documents never learned from: crc32 of the id as text mod folds is 1."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 1


def tokens(texts: list, sizes: Sizes) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """(lengths, codes, word hashes, endings) of texts in chunks of about
    CHUNK_WORDS words: every text's words and its end token, in order, as
    codes of the chunk's distinct words; code 0 is the end."""
    lengths: list[int] = []
    words: list[bytes] = []

    def chunk():
        codes, distinct = pd.factorize(np.array(words, dtype=object))
        own = [w for w in distinct if w is not None]
        h = pd.util.hash_array(np.array(own, dtype=object), categorize=False) if own else (
            np.empty(0, np.uint64))
        h[h == END_HASH] = 1
        tails = [w[-3:] for w in own]
        e = pd.util.hash_array(np.array(tails, dtype=object)) % np.uint64(sizes.endings) if own else (
            np.empty(0, np.uint64))
        # factorize gives -1 for None, the end token
        return lengths, codes + 1, np.r_[END_HASH, h], np.r_[np.uint64(0), e].astype(np.int64)

    for t in texts:
        w = text_words(t)
        lengths.append(len(w) + 1)
        words.extend(w)
        words.append(None)
        if len(words) >= CHUNK_WORDS:
            yield chunk()
            lengths, words = [], []
    if words:
        yield chunk()


def word_counts(docs: DataFrame, text: str, sizes: Sizes) -> DataFrame:
    """(wh, ending, n): each distinct token with its count. Tasks add up
    what they read before anything is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def merged():
            h, e, n = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(h, kind="stable")
            h, e, n = h[order], e[order], n[order]
            edge = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            return h[edge], e[edge], np.add.reduceat(n, edge)

        for b in batches:
            for _, codes, h, e in tokens(b.column(0).to_pylist(), sizes):
                held.append((h, e, np.bincount(codes, minlength=len(h))))
                size += len(h)
                if size > 2_000_000:
                    held = [merged()]
                    size = 0 if len(held[0][0]) < 1_000_000 else size
                    if len(held[0][0]) >= 1_000_000:
                        yield _counts(*held[0])
                        held, size = [], 0
        if held:
            yield _counts(*merged())

    parts = docs.select(F.col(f"`{text}`")).mapInArrow(run, "wh long, ending int, n long")
    return parts.where("n > 0").groupBy("wh").agg(F.first("ending").alias("ending"), F.sum("n").alias("n"))


def _counts(h, e, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(h.view(np.int64)), pa.array(e.astype(np.int32)), pa.array(n.astype(np.int64))],
        ["wh", "ending", "n"])


class Lookup:
    """Positions of hashes in a sorted table, -1 where there is none."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys        # sorted

    def __call__(self, h: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return np.where(self.keys[at] == h, at, -1)


def units_of(head: Lookup, h: np.ndarray, endings: np.ndarray, sizes: Sizes) -> np.ndarray:
    """The unit of each distinct token."""
    at = head(h)
    unit = np.where(at >= 0, 1 + at, 1 + sizes.head + endings)
    return np.where(h == END_HASH, _END_UNIT, unit)


def unit_bigrams(docs: DataFrame, text: str, head_keys: np.ndarray, sizes: Sizes) -> DataFrame:
    """(pair, n): counts of neighbouring units, pair = first * units + second;
    a text starts after the end token of another."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, held = Lookup(head_keys), np.zeros(sizes.units ** 2, np.int32)
        for b in batches:
            for _, codes, h, e in tokens(b.column(0).to_pylist(), sizes):
                u = units_of(head, h, e, sizes)[codes]
                first = np.r_[_END_UNIT, u[:-1]]
                pair, n = np.unique(first * sizes.units + u, return_counts=True)
                held[pair] += n.astype(np.int32)
        pair = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(pair.astype(np.int32)), pa.array(held[pair].astype(np.int64))], ["pair", "n"])

    parts = docs.select(F.col(f"`{text}`")).mapInArrow(run, "pair int, n long")
    return parts.groupBy("pair").agg(F.sum("n").alias("n"))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, classes: int, rounds: int = EXCHANGE_ROUNDS) -> np.ndarray:
    """The class of each unit: units move, one after another and most frequent
    first, to the class that gives the class bigrams the highest likelihood,
    until none moves. The end token keeps a class of its own, 0."""
    b = bigrams.astype(np.float64)
    left, right = b.sum(axis=1), b.sum(axis=0)
    order = np.argsort(-(left + right), kind="stable")
    order = order[order != _END_UNIT]
    cls = np.zeros(len(b), np.int64)
    cls[order] = 1 + np.arange(len(order)) % (classes - 1)
    one = np.zeros((len(b), classes))
    one[np.arange(len(b)), cls] = 1
    c = one.T @ b @ one
    row, col = c.sum(axis=1), c.sum(axis=0)
    diagonal = np.arange(classes)
    for _ in range(rounds):
        moved = 0
        for w in order:
            if left[w] + right[w] == 0:
                continue
            a, own = cls[w], b[w, w]
            out = np.bincount(cls, weights=b[w], minlength=classes)
            into = np.bincount(cls, weights=b[:, w], minlength=classes)
            out[a] -= own
            into[a] -= own
            # take w out of its class
            c[a] -= out
            c[:, a] -= into
            c[a, a] -= own
            row[a] -= left[w]
            col[a] -= right[w]
            f = _xlogx(c)
            to_row, to_col = _xlogx(c + out) - f, _xlogx(c + into[:, None]) - f
            gain = (to_row.sum(axis=1) - to_row[diagonal, diagonal]
                    + to_col.sum(axis=0) - to_col[diagonal, diagonal]
                    + _xlogx(c[diagonal, diagonal] + out + into + own) - f[diagonal, diagonal]
                    - _xlogx(row + left[w]) + _xlogx(row) - _xlogx(col + right[w]) + _xlogx(col))
            gain[0] = -np.inf
            best = int(gain.argmax())
            if gain[best] <= gain[a] + 1e-9:
                best = a
            moved += best != a
            cls[w] = best
            c[best] += out
            c[:, best] += into
            c[best, best] += own
            row[best] += left[w]
            col[best] += right[w]
        if not moved:
            break
    return cls


class Model:
    """Bounded parts of the model: everything but the counts of rare words."""

    def __init__(self, sizes, head_keys, known_keys, known_counts, bigrams, unit_tokens, unit_words):
        self.sizes = sizes
        self.head_keys, self.known_keys, self.known_counts = head_keys, known_keys, known_counts
        self.train_tokens, self.distinct = float(unit_tokens.sum()), float(unit_words.sum())
        self.cls = exchange(bigrams, sizes.classes)
        one = np.zeros((sizes.units, sizes.classes))
        one[np.arange(sizes.units), self.cls] = 1
        pairs = one.T @ bigrams @ one
        n, v = one.T @ unit_tokens, one.T @ unit_words
        share = (n + 0.5) / (n.sum() + 0.5 * sizes.classes)
        self.transition = np.log10((pairs + TRANSITION_PRIOR * share)
                                   / (pairs.sum(axis=1, keepdims=True) + TRANSITION_PRIOR))
        # emission (c + 0.5) / (class tokens + 0.5 * (class words + 1))
        self.emission_log = np.log10(n + 0.5 * (v + 1))
        self.base_log = np.log10(self.train_tokens + 0.5 * (self.distinct + 1))


def train(docs: DataFrame, text: str = "text", sizes: Sizes = Sizes()) -> tuple[Model, DataFrame]:
    """(model, counts): learned from all of ``docs``; counts holds every
    distinct token and stays distributed."""
    counts = cut_lineage(word_counts(docs, text, sizes))
    end = int(END_HASH.view(np.int64))
    top = (counts.where(F.col("wh") != end).orderBy(F.desc("n"), "wh").limit(sizes.known)
           .select("wh", "ending", "n").toArrow())
    wh, n = top["wh"].to_numpy().view(np.uint64), top["n"].to_numpy()
    by_count = np.lexsort((wh, -n))
    head_keys = np.sort(wh[by_count[:sizes.head]])
    order = np.argsort(wh)
    known_keys, known_counts = wh[order], n[order]
    end_count = counts.where(F.col("wh") == end).agg(F.sum("n")).first()[0] or 0
    known_keys, known_counts = np.r_[END_HASH, known_keys], np.r_[end_count, known_counts]

    pairs = unit_bigrams(docs, text, head_keys, sizes).toArrow()   # at most units squared
    bigrams = np.zeros(sizes.units ** 2)
    bigrams[pairs["pair"].to_numpy()] = pairs["n"].to_numpy()

    by_unit = counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"))
    unit_tokens, unit_words = np.zeros(sizes.units), np.zeros(sizes.units)
    for r in by_unit.collect():                                 # at most sizes.endings rows
        unit_tokens[1 + sizes.head + r.ending], unit_words[1 + sizes.head + r.ending] = r.n, r.v
    # head words and the end are units of their own
    at = Lookup(head_keys)(wh)
    for k in np.flatnonzero(at >= 0):
        own, ending = 1 + at[k], 1 + sizes.head + top["ending"][int(k)].as_py()
        unit_tokens[own], unit_words[own] = n[k], 1
        unit_tokens[ending] -= n[k]
        unit_words[ending] -= 1
    unit_tokens[_END_UNIT], unit_words[_END_UNIT] = end_count, float(end_count > 0)
    unit_tokens[1 + sizes.head] -= end_count      # the end was counted under ending 0
    unit_words[1 + sizes.head] -= float(end_count > 0)
    return Model(sizes, head_keys, known_keys, known_counts, bigrams.reshape(sizes.units, -1),
                 unit_tokens, unit_words), counts


def score(docs: DataFrame, model: Model, counts: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` plus n_tokens, n_known, base_score and score per row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value
        head, known = Lookup(m.head_keys), Lookup(m.known_keys)

        def of(texts: list) -> dict:
            out = {c: [] for c in ("n_tokens", "n_known", "counts_log", "outer_log", "rare", "times")}
            for lengths, codes, h, e in tokens(texts, m.sizes):
                cls = m.cls[units_of(head, h, e, m.sizes)]
                at = known(h)
                log_c = np.where(at >= 0, np.log10(m.known_counts[np.maximum(at, 0)] + 0.5), 0.0)[codes]
                is_known = (at >= 0)[codes]
                in_class = cls[codes]
                before = np.r_[m.cls[_END_UNIT], in_class[:-1]]
                outer = m.transition[before, in_class] - m.emission_log[in_class]
                start = 0
                for n in lengths:
                    z = start + n
                    mine = is_known[start:z]
                    rare, times = np.unique(h[codes[start:z][~mine]].view(np.int64), return_counts=True)
                    for c, v in zip(out, (n, int(mine.sum()), float(log_c[start:z].sum()),
                                          float(outer[start:z].sum()), rare, times)):
                        out[c].append(v)
                    start = z
            return out
        return of

    names = {"n_tokens": "long", "n_known": "long", "counts_log": "double", "outer_log": "double",
             "rare": "array<long>", "times": "array<long>"}
    parts = map_texts(docs, keep, text, make, names)
    # the number is stored with the row, so it stays the row's
    parts = cut_lineage(parts.withColumn("__row", F.monotonically_increasing_id()))
    rare = (parts.select("__row", F.explode(F.arrays_zip("rare", "times")).alias("r"))
            .select("__row", F.col("r.rare").alias("wh"), F.col("r.times").alias("times")))
    half = float(np.log10(0.5))
    # only tokens beyond the broadcast table can be missing from it
    looked = rare.join(counts.select("wh", "n"), "wh", "left")
    found = looked.groupBy("__row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more"),
        F.sum(F.col("times") * F.coalesce(F.log10(F.col("n") + 0.5), F.lit(half))).alias("more_log"))
    total = F.col("counts_log") + F.coalesce("more_log", F.lit(0.0))
    return (parts.join(found, "__row", "left").select(
        *keep, "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        (total - F.col("n_tokens") * float(model.base_log)).alias("base_score"),
        (total + F.col("outer_log")).alias("score")))


def train_and_score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    sizes: Sizes = Sizes()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score
    of every row, learning from the rows that are not held out."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), held_out(F.col(f"`{doc_id}`")).alias("held_out"),
                       F.col(f"`{text}`").alias("text"))
    model, counts = train(rows.where(~F.col("held_out")), "text", sizes)
    out = score(rows, model, counts, ["doc_id", "held_out"], "text")
    return out.withColumn("train_tokens", F.lit(int(model.train_tokens)).cast("long"))
