"""Retrieval: exact vector top-k, category filter with fallback, ranking,
comparison lists and text embeddings (T1-T4, P6, E1-E3)."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as TX
from ..functions import vector as V
from ..session import cut_lineage
from . import guard


def _vectors(col: pa.Array, n: int) -> np.ndarray:
    """Arrow list<float|double> column -> (n, dim) float64 matrix."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if n == 0:
        return np.zeros((0, 0))
    offsets = col.offsets.to_numpy()
    dims = np.diff(offsets)
    if dims.min() != dims.max():
        raise ValueError("vectors of different lengths")
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(n, int(dims[0]))


def _topk_cols(ids: np.ndarray, s: np.ndarray, k: int) -> np.ndarray:
    """Row positions of the k best rows per column of s (n x q), by
    (score desc, id asc).

    argpartition finds the cut quickly; columns where equal scores straddle
    the cut are re-done with an exact lexicographic sort, so ties are always
    broken by the smaller id.
    """
    n = s.shape[0]
    kk = min(k, n)
    part = np.argpartition(-s, kk - 1, axis=0)[:kk] if kk < n else np.tile(
        np.arange(n)[:, None], (1, s.shape[1]))
    sel = np.take_along_axis(s, part, axis=0)
    cut = sel.min(axis=0)
    straddle = np.nonzero((s == cut).sum(axis=0) > (sel == cut).sum(axis=0))[0]
    for j in straddle:
        part[:, j] = np.lexsort((ids, -s[:, j]))[:kk]
    return part


SCORE_ROWS = 256            # products whose scores a task holds at a time,
SCORE_COLS = 2_048          # for as many queries


class Best:
    """The k best products of each query of a block: (k x q) arrays of ids,
    scores and payload values, by (score desc, id asc). Products come in any
    order and number. Scores are computed SCORE_ROWS x SCORE_COLS at a time and
    only those that reach a query's k-th best so far are looked at, so memory is
    a few MB and the cost per score is that of the product and a comparison."""

    def __init__(self, qids: np.ndarray, qmat: np.ndarray, k: int, payload: int = 0):
        self.qids, self.qmat, self.k = qids, qmat, k
        self.ids = np.full((k, len(qids)), np.iinfo(np.int64).max)
        self.scores = np.full((k, len(qids)), -np.inf)
        self.pay = [np.full((k, len(qids)), None, dtype=object) for _ in range(payload)]

    def meet(self, ids: np.ndarray, mat: np.ndarray, payload: Callable[[np.ndarray], list] | None = None,
             cols: np.ndarray | None = None, exclude_self: bool = False) -> None:
        """Score products (ids, mat) against the queries at ``cols`` (all if
        None); ``payload(rows)`` gives the payload columns of some of them."""
        if mat.shape[1] != self.qmat.shape[1]:
            raise ValueError("vectors of different lengths")
        cols = np.arange(len(self.qids)) if cols is None else cols
        for c in (cols[lo:lo + SCORE_COLS] for lo in range(0, len(cols), SCORE_COLS)):
            q = np.ascontiguousarray(self.qmat[c], dtype=np.float64).T
            for lo in range(0, len(ids), SCORE_ROWS):
                part = ids[lo:lo + SCORE_ROWS]
                s = mat[lo:lo + SCORE_ROWS].astype(np.float64, copy=False) @ q
                row, col = self._reach(part, s, c, exclude_self)
                if len(row):
                    score = s[row, col] + 0.0       # no negative zero
                    self._merge(c[col], part[row], score, payload(row + lo) if payload else [])

    def _reach(self, ids, s, c, exclude_self) -> tuple[np.ndarray, np.ndarray]:
        """Places in s of the scores that may be among the k best."""
        least, last = self.scores[-1, c], self.ids[-1, c]
        hit = s >= least
        new = np.flatnonzero(np.isneginf(least))        # fewer than k so far: the k best of these rows
        if len(new):
            hit[:, new] = False
        row, col = np.nonzero(hit)
        tied = (s[row, col] == least[col]) & (ids[row] >= last[col])
        keep = ~tied & (ids[row] != self.qids[c[col]]) if exclude_self else ~tied
        row, col = row[keep], col[keep]
        if len(new):
            t = np.where(np.isnan(sub := s[:, new]), -np.inf, sub)
            if exclude_self:
                t[ids[:, None] == self.qids[c[new]][None, :]] = -np.inf
            pos = _topk_cols(ids, t, self.k)
            some = np.take_along_axis(t, pos, axis=0) > -np.inf
            row = np.concatenate([row, pos[some]])
            col = np.concatenate([col, np.broadcast_to(new[None, :], pos.shape)[some]])
        return row, col

    def _merge(self, col, ids, scores, pay) -> None:
        u, at = np.unique(col, return_inverse=True)
        at = np.concatenate([np.tile(np.arange(len(u)), self.k), at])
        ids = np.concatenate([self.ids[:, u].ravel(), ids])
        scores = np.concatenate([self.scores[:, u].ravel(), scores])
        order = np.lexsort((ids, -scores, at))
        rank = np.arange(len(order)) - np.searchsorted(at[order], np.arange(len(u)))[at[order]]
        order, rank = order[rank < self.k], rank[rank < self.k]
        to = rank, u[at[order]]
        for held, new in zip(self.pay, pay):
            values = np.empty(len(new), dtype=object)
            values[:] = new
            held[to] = np.concatenate([held[:, u].ravel(), values])[order]
        self.ids[to], self.scores[to] = ids[order], scores[order]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Columns (query id, product id, score, payload) of the finite scores."""
        keep = np.isfinite(self.scores)
        return (np.broadcast_to(self.qids[None, :], keep.shape)[keep], self.ids[keep], self.scores[keep],
                [p[keep] for p in self.pay])


BLOCK_ROWS = 2_048          # queries, or products, packed in one row


def own_dtype(df: DataFrame, vec: str) -> np.dtype:
    """Floats are kept as floats, all else as doubles."""
    return np.dtype(np.float32 if df.schema[vec].dataType.elementType == T.FloatType() else np.float64)


def _packed(df: DataFrame, vec: str, names: Sequence[str], prefix: str) -> DataFrame:
    """Rows of up to BLOCK_ROWS vectors, where they are read: the named
    columns as arrays and the vectors as one binary of their own type."""
    own = own_dtype(df, vec)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(lo, BLOCK_ROWS)
                arrays = [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(n))
                          for n in names]
                mat = _vectors(part.column(vec), part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array([mat.astype(own).tobytes()], pa.binary())],
                    [*[prefix + n for n in names], prefix + "mat"])

    fields = [f"`{prefix}{n}` array<{df.schema[n].dataType.simpleString()}>" for n in names]
    return df.mapInArrow(pack, ", ".join([*fields, f"`{prefix}mat` binary"]))


def _typed(df: DataFrame) -> DataFrame:
    """Rows with a vector ``v``, of floats or (anything else) doubles."""
    if df.schema["v"].dataType.elementType != T.FloatType():
        df = df.withColumn("v", F.col("v").cast("array<double>"))
    return df.where(F.col("v").isNotNull())


def vector_topk(products: DataFrame, queries: DataFrame, k: int = 3, *,
                product_id: str = "product_id", query_id: str = "query_id",
                product_vec: str = "embedding", query_vec: str = "embedding",
                payload: Sequence[str] = (), exclude_self: bool = False, digits: int = 6,
                keep_raw: bool = False) -> DataFrame:
    """Exact top-k products per query by dot product (cosine on unit vectors).

    Output ``(query_id, product_id, score, rank, *payload)``: rank 1..k by
    (score desc, product id asc) with the score as computed in double
    precision, then rounded to ``digits``; ``keep_raw`` adds the unrounded
    ``raw_score``. ``payload`` product columns (type, name, ...) travel with
    the winners, so callers never join the results back to the products.

    Plan: both sides are packed, where they are read, into rows of up to
    BLOCK_ROWS vectors. The query blocks are dealt over twice as many partitions
    as there are cores, product blocks in fewer partitions than there are cores
    over all of them, so that no worker packs while another scores for the same
    task and a task meets a few blocks of each side. The stated query set meets
    the products block by block in a grid of such rows; a cell's matrix product
    is made in pieces (see ``Best``), and a task keeps only the k best per query
    over its cells. Nothing is collected and no job runs before the caller's
    action; Spark broadcasts the packed queries if they are small by its own
    estimate. A final ``row_number <= k`` per query merges the tasks' candidates.
    """
    payload = list(payload)
    q = _typed(queries.select(F.col(query_id).cast("long").alias("qid"), F.col(query_vec).alias("v")))
    p = _typed(products.select(F.col(product_id).cast("long").alias("pid"), F.col(product_vec).alias("v"), *payload))
    pay_fields = [products.schema[c] for c in payload]
    out_schema = T.StructType([T.StructField(query_id, T.LongType()),
                               T.StructField(product_id, T.LongType()),
                               T.StructField("raw_score", T.DoubleType())]
                              + [T.StructField(f.name, f.dataType) for f in pay_fields])
    from pyspark.sql.pandas.types import to_arrow_type

    pay_arrow = [to_arrow_type(f.dataType) for f in pay_fields]
    p_own, q_own = own_dtype(p, "v"), own_dtype(q, "v")
    cores = products.sparkSession.sparkContext.defaultParallelism
    cells = guard.spread(_packed(p, "v", ["pid", *payload], "p_")).crossJoin(
        _packed(q, "v", ["qid"], "q_").repartition(2 * cores))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[bytes, Best] = {}
        for batch in batches:
            for r in range(batch.num_rows):
                qids, ids = (batch.column(c)[r].values.to_numpy(zero_copy_only=False)
                             for c in ("q_qid", "p_pid"))
                qmat, mat = (np.frombuffer(batch.column(c)[r].as_buffer(), t).reshape(len(x), -1)
                             for c, x, t in (("q_mat", qids, q_own), ("p_mat", ids, p_own)))
                if (block := qids.tobytes()) not in best:       # a copy, so that the batch can go
                    best[block] = Best(qids.copy(), qmat, k, len(payload))
                held = best[block]
                held.qmat = qmat
                values = [batch.column(f"p_{c}")[r].values for c in payload]
                held.meet(ids, mat, lambda rows, v=values: [x.take(pa.array(rows)).to_pylist() for x in v],
                          exclude_self=exclude_self)
                held.qmat = None
        batch = qids = qmat = ids = mat = values = held = None
        pa.default_memory_pool().release_unused()       # the worker lives on
        for held in best.values():
            qcol, pcol, scores, pay = held.found()
            yield pa.RecordBatch.from_arrays(
                [pa.array(qcol, pa.int64()), pa.array(pcol, pa.int64()), pa.array(scores, pa.float64()),
                 *[pa.array(list(x), type=t) for x, t in zip(pay, pay_arrow)]],
                names=[f.name for f in out_schema.fields])

    w = Window.partitionBy(query_id).orderBy(F.col("raw_score").desc(), F.col(product_id).asc())
    out = (cells.mapInArrow(score, out_schema)
           .withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)
           .select(query_id, product_id, F.round("raw_score", digits).alias("score"), "rank",
                   "raw_score", *payload))
    return out if keep_raw else out.drop("raw_score")


def category_fallback(results: DataFrame, query_id: str, type_col: str, target_col: str,
                      out_hit: str | None = None) -> DataFrame:
    """Keep results of the target type; if a query has no target (null or
    ''), or none of its results has the target type, keep all its results.

    The window is per query over its top-k rows only, so it is bounded.
    """
    w = Window.partitionBy(query_id)
    target = F.col(target_col)
    has_target = target.isNotNull() & (target.cast("string") != "")
    match = F.coalesce(F.col(type_col) == target, F.lit(False))
    hit = F.max(F.when(has_target & match, 1).otherwise(0)).over(w)
    r = results.withColumn("__hit", hit)
    r = r.where((F.col("__hit") == 0) | match)
    return r.withColumnRenamed("__hit", out_hit) if out_hit else r.drop("__hit")


def rank_results(results: DataFrame, group: Sequence[str], score: str, tie: str,
                 out: str = "rank", digits: int | None = None) -> DataFrame:
    """Rank within each group by score (desc), explicit tie-break column.

    Groups here are a query's k results, so the window stays small.
    ``digits`` rounds the score first, as Python's ``round`` does.
    """
    s = TX.py_round(F.col(score), digits) if digits is not None else F.col(score)
    r = results.withColumn(score, s) if digits is not None else results
    w = Window.partitionBy(*group).orderBy(F.col(score).desc(), F.col(tie).asc())
    return r.withColumn(out, F.row_number().over(w).cast("long"))


def best_per_group(df: DataFrame, group: Sequence[str], score: Column | str, tie: str,
                   keep: Sequence[str]) -> DataFrame:
    """The top row per group by (score desc, tie asc). ``row_number = 1`` gets
    a partial WindowGroupLimit, so a hot group ships one row per task."""
    s = F.col(score) if isinstance(score, str) else score
    w = Window.partitionBy(*group).orderBy(s.desc(), F.col(tie).asc())
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").select(*group, *keep)


def comparison_list(df: DataFrame, group: Sequence[str], order: Sequence, n: int,
                    line: Column, out: str = "lines", sep: str = "\n") -> DataFrame:
    """First n rows per group (by ``order``) rendered as lines and joined.

    ``row_number <= n`` gets a partial WindowGroupLimit, and the collected
    list per group holds at most n entries.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    top = df.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n)
    lines = F.sort_array(F.collect_list(F.struct(F.col("__r"), line.alias("__l"))))
    return top.groupBy(*group).agg(F.array_join(F.transform(lines, lambda x: x["__l"]), sep)
                                   .alias(out))


# ---------------------------------------------------------------------------
# Embeddings
# ---------------------------------------------------------------------------

def l2_normalize(df: DataFrame, vec: str, out: str | None = None) -> DataFrame:
    """Unit-length vectors; null for zero or null vectors. The norm is a
    column of its own, computed once per row (inside the element lambda it
    would be recomputed for every element)."""
    n = df.withColumn("__norm", V.norm(vec))
    unit = F.when(F.col("__norm") > 0,
                  F.transform(V.as_double(vec), lambda x: x / F.col("__norm")))
    return n.withColumn(out or vec, unit).drop("__norm")


MAX_WORDS = 200_000         # words whose bucket a task remembers at a time
WORDS_AT_A_TIME = 250_000   # of a batch that are looked at together


def _words(text_col: str) -> Column:
    """Runs of letters and digits of any script, lower case."""
    return F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[^\p{L}\p{N}]+"),
                    lambda w: w != "")


def _bucket(word: str, dim: int) -> int:
    """The first 32 bits of a word's MD5 modulo dim."""
    return int.from_bytes(hashlib.md5(word.encode("utf-8", "surrogatepass")).digest()[:4], "big") % dim


def _buckets(words: pa.ListArray, dim: int, known: dict[str, int]) -> pa.ListArray:
    """The bucket of each word. Words stay in Arrow's memory: WORDS_AT_A_TIME of
    them are numbered there, and only those met for the first time (as long as
    they are among the last MAX_WORDS new ones) become strings and are hashed."""
    flat = words.flatten()
    out = np.empty(len(flat), np.int32)
    for lo in range(0, len(flat), WORDS_AT_A_TIME):
        coded = flat.slice(lo, WORDS_AT_A_TIME).dictionary_encode()
        of = np.empty(len(coded.dictionary), np.int32)
        for i, word in enumerate(coded.dictionary.to_pylist()):
            if (bucket := known.get(word)) is None:
                if len(known) >= MAX_WORDS:
                    known.clear()
                bucket = known[word] = _bucket(word, dim)
            of[i] = bucket
        out[lo:lo + WORDS_AT_A_TIME] = of[coded.indices.to_numpy()]
    ends = words.offsets.to_numpy()
    return pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), pa.array(out, pa.int32()))


def hash_words(df: DataFrame, text_col: str, dim: int, out: str = "__buckets") -> DataFrame:
    """``df`` with the bucket of each word of the text, in order."""
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def bucket(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, int] = {}
        for words in it:
            yield _buckets(words, dim, known)
        pa.default_memory_pool().release_unused()       # the worker lives on

    return df.withColumn(out, bucket(_words(text_col)))


class HashingEncoder:
    """The default encoder, no download: words -> hashed counts -> inverse
    document frequency -> unit length. The model is ``dim`` numbers."""

    def __init__(self, idf: np.ndarray):
        self.idf, self.dim = idf, len(idf)


def _fit(hashed: DataFrame, dim: int) -> HashingEncoder:
    each = F.explode(F.concat(F.array(F.lit(-1)), F.array_distinct("__buckets")))
    counts = dict(map(tuple, hashed.select(each.alias("b")).groupBy("b").count().collect()))
    df = np.array([counts.get(b, 0) for b in range(dim)], dtype=np.float64)
    return HashingEncoder(np.log((counts.get(-1, 0) + 1) / (df + 1)))


def fit_hashing_encoder(texts: DataFrame, text_col: str, dim: int = 256) -> HashingEncoder:
    """Fit on a corpus: ln((N + 1) / (df + 1)) per bucket. One distributed
    pass; at most ``dim`` + 1 rows reach the driver."""
    return _fit(hash_words(guard.spread(texts.select(text_col)), text_col, dim), dim)


def _weigh(model: HashingEncoder, hashed: DataFrame, out: str) -> DataFrame:
    idf = model.idf

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def weigh(buckets: pd.Series) -> pd.Series:
        rows = []
        for b in buckets:
            v = np.bincount(np.asarray(b, dtype=np.int64), minlength=len(idf)) * idf
            n = np.sqrt((v * v).sum())
            rows.append((v / n if n > 0 else v).astype(np.float32))
        return pd.Series(rows)

    return hashed.withColumn(out, weigh("__buckets")).drop("__buckets")


def embed(model: HashingEncoder, df: DataFrame, text_col: str, out: str = "embedding") -> DataFrame:
    """Apply a fitted encoder (the same one for products and queries): each
    row's ``out`` is a vector of floats, zero for a text without known words."""
    return _weigh(model, hash_words(guard.spread(df), text_col, model.dim), out)


def fit_embed(texts: DataFrame, text_col: str, dim: int = 256, out: str = "embedding"):
    """(encoder fitted on a corpus, that corpus embedded). The words are
    hashed once: their buckets are kept in the shared checkpoint folder for
    the fit and the embedding."""
    hashed = cut_lineage(hash_words(guard.spread(texts), text_col, dim))
    model = _fit(hashed, dim)
    return model, _weigh(model, hashed, out)


def embed_with(df: DataFrame, text_col: str, encoder_factory: Callable[[], Callable],
               dim: int, out: str = "embedding", batch_size: int = 32) -> DataFrame:
    """Plug in any encoder: ``encoder_factory()`` runs once per task and
    returns ``f(list[str]) -> ndarray (n, dim)``. Rows arrive as an iterator of
    Arrow batches; the encoder is called with exactly ``batch_size`` texts at a
    time, across the batches' borders (the last call of a task may get fewer).
    Null texts are empty; the vectors are L2-normalised, zero ones kept."""
    names = df.columns
    kept = [c for c in names if c != out]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(out, T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = encoder_factory()
        held: pa.Table | None = None

        def encode(rows: pa.Table) -> pa.RecordBatch:
            texts = [t or "" for t in rows.column(text_col).to_pylist()]
            m = np.concatenate([np.asarray(f(texts[lo:lo + batch_size]), dtype=np.float32).reshape(-1, dim)
                                for lo in range(0, len(texts), batch_size)])
            n = np.linalg.norm(m.astype(np.float64), axis=1, keepdims=True)
            m = (m / np.where(n > 0, n, 1)).astype(np.float32)
            vec = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * dim, pa.int32()), pa.array(m.ravel()))
            return pa.RecordBatch.from_arrays([*[_one_chunk(rows.column(c)) for c in kept], vec], [*kept, out])

        for b in batches:
            rows = pa.Table.from_batches([b])
            held = rows if held is None else pa.concat_tables([held, rows])
            whole = held.num_rows // batch_size * batch_size
            if whole:
                yield encode(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield encode(held)

    return df.mapInArrow(run, schema).select(*dict.fromkeys([*names, out]))


def _one_chunk(col: pa.ChunkedArray) -> pa.Array:
    whole = col.combine_chunks()
    return whole if isinstance(whole, pa.Array) else pa.concat_arrays(whole.chunks)
