"""Cell-indexed vector top-k (T1, J5): an inverted file of k-means cells.

The index is a table partitioned by cell. A query visits the cells it is
nearest to, in an equi-join on the cell, and the vectors met there are
reranked exactly. Every vector is indexed; only the cells' centres come from a
bounded sample.

``topk`` visits ``probes`` cells (an approximate answer) or, with
``exact=True``, then also every other cell that may hold a better vector:
within a cell of radius r around centre c no product q.x exceeds q.c + |q| r,
so a cell whose bound stays below the k-th score found so far can't change the
answer. ``calibrate`` finds the number of probes that reaches a recall on the data at
hand: a few for vectors that cluster, most cells for vectors without structure.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, ensure_checkpoint_dir
from . import guard
from .retrieve import Best, _typed, _vectors, own_dtype

SAMPLE = 16_384             # vectors the centres are fitted on, at most
MAX_CELLS = 1_024           # so that there are some sample vectors for each
ROUNDS = 8                  # of k-means
BLOCK_ROWS = 2_048          # vectors packed in one row; queries looked at together
GROUP_ROWS = 32_768         # vectors, and queries, that meet in one task at a time


class CellIndex(NamedTuple):
    """Folder of the packed vectors (partitioned by cell), the cells' centres,
    their radii and numbers of vectors; ``payload`` are the columns stored with
    the vectors."""

    path: str
    centres: np.ndarray
    radii: np.ndarray
    sizes: np.ndarray
    payload: T.StructType
    dtype: str


def fit_centres(vectors: DataFrame, vec: str, key: str, cells: int, sample: int = SAMPLE,
                rounds: int = ROUNDS) -> np.ndarray:
    """k-means centres of a sample of at most ``sample`` vectors (those whose
    ids hash lowest), from evenly spaced starts in that order. Each round is a
    job whose tasks return one sum per cell; the driver only divides them."""
    spark = vectors.sparkSession
    chosen = cut_lineage(vectors.where(F.col(vec).isNotNull()).select(
        F.xxhash64(key).alias("h"), F.col(vec).cast("array<double>").alias("v")).orderBy("h", "v").limit(sample))
    n = chosen.count()
    if not n:
        return np.zeros((0, 0))
    at = sorted(set(np.linspace(0, n - 1, min(cells, n)).astype(int).tolist()))
    place = F.row_number().over(Window.orderBy("h", "v")) - 1       # over the sample only
    starts = chosen.withColumn("i", place).where(F.col("i").isin(at)).select("v").toArrow()
    centres = _vectors(starts["v"], starts.num_rows)
    rows = cut_lineage(chosen.select("v").repartition(spark.sparkContext.defaultParallelism))
    for _ in range(rounds):
        def sums(batches: Iterator[pa.RecordBatch], c=centres) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros_like(c), np.zeros(len(c))
            for b in batches:
                for part in _slices(b):
                    m = _vectors(part.column(0), part.num_rows)
                    own = _nearest(m, c, 1)[:, 0]
                    np.add.at(total, own, m)
                    count += np.bincount(own, minlength=len(c))
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()]), pa.array([count.tobytes()])], ["s", "n"])

        parts = rows.mapInArrow(sums, "s binary, n binary").toArrow()       # a row for each task
        total = sum(np.frombuffer(x, np.float64) for x in parts["s"].to_pylist()).reshape(centres.shape)
        count = sum(np.frombuffer(x, np.float64) for x in parts["n"].to_pylist())
        centres = centres.copy()
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


def _slices(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of BLOCK_ROWS rows: a row meets every centre."""
    return (b.slice(lo, BLOCK_ROWS) for lo in range(0, b.num_rows, BLOCK_ROWS))


def _nearest(m: np.ndarray, centres: np.ndarray, n: int, product=np.matmul) -> np.ndarray:
    """The n nearest centres of each row (Euclidean), nearest first."""
    far = (centres * centres).sum(axis=1)[None, :] - 2 * product(m, centres.T)
    n = min(n, len(centres))
    part = np.argpartition(far, n - 1, axis=1)[:, :n] if n < len(centres) else np.tile(
        np.arange(len(centres)), (len(m), 1))
    order = np.argsort(np.take_along_axis(far, part, axis=1), axis=1, kind="stable")
    return np.take_along_axis(part, order, axis=1)


def _one_core(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A matrix product without numpy's threads, for the driver: they may lock
    up in a process that has forked."""
    return np.einsum("ij,jk->ik", a, b)


def default_cells(n: int) -> int:
    """About the square root of the number of vectors, up to MAX_CELLS."""
    return max(1, min(MAX_CELLS, int(round(n ** 0.5))))


def build(vectors: DataFrame, path: str, *, vec: str = "embedding", key: str = "product_id",
          payload: Sequence[str] = (), cells: int | None = None, sample: int = SAMPLE) -> CellIndex:
    """Write the index of ``vectors`` (null vectors are left out) to ``path``:
    ``cell=<c>/`` holds rows of up to BLOCK_ROWS vectors with their ids and
    payload. A large cell is dealt over several tasks by a hash of the id."""
    v = vectors.where(F.col(vec).isNotNull())
    centres = fit_centres(v, vec, key, cells or default_cells(v.count()), sample)
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(centres)
    read = guard.spread(_typed(v.select(F.col(vec).alias("v"), F.col(key).cast("long").alias("__id"), *payload)))
    dtype = own_dtype(read, "v")
    names = ["__id", *payload]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for b in (part for whole in batches for part in _slices(whole)):
            m = _vectors(b.column("v"), b.num_rows)
            own = _nearest(m, c, 1)[:, 0]
            gap = np.sqrt(((m - c[own]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int32()), pa.array(gap), _binary(m.astype(dtype)), *[b.column(n) for n in names]],
                ["cell", "gap", "vec", *names])

    kinds = {"__id": "long", **{c: vectors.schema[c].dataType.simpleString() for c in payload}}
    fields = ", ".join(f"`{n}` {k}" for n, k in kinds.items())
    placed = cut_lineage(read.mapInArrow(assign, f"cell int, gap double, vec binary, {fields}"))
    size = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("r"))
    stats = {r.cell: (r.n, r.r) for r in size.collect()}             # a row for each cell
    sizes, radii = (np.array([stats.get(c, (0, 0.0))[i] for c in range(len(centres))]) for i in (0, 1))
    blocks = F.broadcast(spark.createDataFrame(
        [(c, -(-n // BLOCK_ROWS)) for c, (n, _) in stats.items()], "cell int, blocks long"))

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("__id")
        one = [pa.array([group[n][0].as_py()], t) for n, t in (("cell", pa.int32()), ("blk", pa.int64()))]
        one += [pa.ListArray.from_arrays([0, group.num_rows], group[n].combine_chunks()) for n in names]
        one.append(pa.array([b"".join(group["vec"].to_pylist())], pa.binary()))
        return pa.table(one, ["cell", "blk", *names, "mat"])

    lists = ", ".join(f"`{n}` array<{k}>" for n, k in kinds.items())
    packed = (placed.drop("gap").join(blocks, "cell")
              .withColumn("blk", F.pmod(F.xxhash64("__id"), F.col("blocks"))).drop("blocks")
              .groupBy("cell", "blk").applyInArrow(pack, f"cell int, blk long, {lists}, mat binary"))
    packed.write.mode("overwrite").partitionBy("cell").parquet(path)
    return CellIndex(path, centres, radii, sizes, T.StructType([vectors.schema[c] for c in payload]), dtype.str)


def _binary(m: np.ndarray) -> pa.Array:
    """The rows of a matrix as binaries."""
    ends = np.arange(len(m) + 1, dtype=np.int32) * np.int32(m.shape[1] * m.itemsize if len(m) else 0)
    return pa.Array.from_buffers(pa.binary(), len(m), [None, pa.py_buffer(ends), pa.py_buffer(m.tobytes())])


def topk(index: CellIndex, queries: DataFrame, k: int = 3, *, probes: int = 8, exact: bool = False,
         query_id: str = "query_id", query_vec: str = "embedding", product_id: str = "product_id",
         exclude_self: bool = False, digits: int = 6) -> DataFrame:
    """``(query_id, product_id, score, rank, *payload)`` like ``vector_topk``,
    from the cells visited. With ``exact`` the result is the same as that of
    ``vector_topk``; else a query meets the vectors of its ``probes`` nearest
    cells only, so the work is queries x probes x cell size."""
    spark = queries.sparkSession
    q = guard.spread(_typed(queries.select(F.col(query_id).cast("long").alias("qid"), F.col(query_vec).alias("v"))))
    pay = index.payload.fields
    if not len(index.centres):
        schema = T.StructType([T.StructField(query_id, T.LongType()), T.StructField(product_id, T.LongType()),
                               T.StructField("score", T.DoubleType()), T.StructField("rank", T.LongType()), *pay])
        return spark.createDataFrame([], schema)
    own, n = own_dtype(q, "v").str, q.count()

    def nearest(m: np.ndarray, _least, c: np.ndarray, _r) -> np.ndarray:
        want = np.zeros((len(m), len(c)), bool)
        np.put_along_axis(want, _nearest(m, c, probes), True, axis=1)
        return want

    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("pid").asc())

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    def met(asked: DataFrame, wanted) -> DataFrame:
        return _met(index, _visits(index, asked, own, wanted), own, n, k, exclude_self, pay)

    found = best(met(q.withColumn("kth", F.lit(None).cast("double")), nearest))
    if exact:
        found = cut_lineage(found)
        kth = found.where(F.col("rank") == k).select("qid", F.col("score").alias("kth"))

        def others(m: np.ndarray, least: np.ndarray, c: np.ndarray, r: np.ndarray) -> np.ndarray:
            norm = np.sqrt((m * m).sum(axis=1))
            bound = m @ c.T + norm[:, None] * r[None, :]
            least = np.where(np.isnan(least), -np.inf, least)
            # a margin for rounding; cells visited already are left out
            todo = bound >= (least - 1e-9 * (1 + np.abs(least)))[:, None]
            np.put_along_axis(todo, _nearest(m, c, probes), False, axis=1)
            return todo

        more = q.join(kth, "qid", "left").select("qid", "v", "kth")
        found = best(found.drop("rank").unionByName(met(more, others)))
    return found.select(F.col("qid").alias(query_id), F.col("pid").alias(product_id),
                        F.round("score", digits).alias("score"), F.col("rank").cast("long").alias("rank"),
                        *index.payload.names)


CALIBRATION_QUERIES = 512


def calibrate(index: CellIndex, queries: DataFrame, k: int = 3, *, target: float = 0.97,
              sample: int = CALIBRATION_QUERIES, query_id: str = "query_id", query_vec: str = "embedding",
              exclude_self: bool = False) -> int:
    """The least number of probes that finds a share ``target`` of the true
    k nearest of a sample of ``sample`` queries (those whose ids hash lowest),
    which meet all cells once."""
    if not len(index.centres):
        return 1
    asked = (queries.select(F.col(query_id).cast("long").alias("qid"), F.col(query_vec).cast("array<double>").alias("v"))
             .where(F.col("v").isNotNull()).orderBy(F.xxhash64("qid"), "qid").limit(sample))
    spark = queries.sparkSession
    rows = asked.toArrow()                                          # at most ``sample`` rows
    if not rows.num_rows:
        return 1
    order = _nearest(_vectors(rows["v"], rows.num_rows), index.centres, len(index.centres), _one_core)
    place = {q: np.argsort(o) for q, o in zip(rows["qid"].to_pylist(), order)}
    asked = spark.createDataFrame(rows).repartition("qid").withColumn("kth", F.lit(None).cast("double"))
    every = _visits(index, asked, "<f8", lambda m, _least, c, _r: np.ones((len(m), len(c)), bool))
    met = _met(index, every, "<f8", rows.num_rows, k, exclude_self, [])
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("pid").asc())
    true = met.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("qid", "cell").collect()
    needed = np.sort([int(place[r.qid][r.cell]) + 1 for r in true])
    return int(needed[max(0, int(np.ceil(target * len(needed))) - 1)]) if len(needed) else 1


def _groups(index: CellIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of vectors before each cell, its first and its last group): the
    blocks of all cells in order are cut into groups of about GROUP_ROWS
    vectors, so small cells share a group and a hot one has several."""
    before = np.concatenate([[0], np.cumsum(index.sizes)[:-1]])
    return before, before // GROUP_ROWS, (before + np.maximum(index.sizes, 1) - 1) // GROUP_ROWS


def _visits(index: CellIndex, asked: DataFrame, own: str, wanted) -> DataFrame:
    """(grp, qid, vec, mask): a row for each group of cells that a query visits,
    ``mask`` telling which of the group's cells. ``asked``: (qid, v, kth);
    ``wanted(vectors, kths, centres, radii)`` tells the cells of each query."""
    _, first, last = _groups(index)
    of = [(g, int(np.argmax(last >= g)), int(np.searchsorted(first, g, side="right")))
          for g in range(int(last[-1]) + 1)]
    shared = asked.sparkSession.sparkContext.broadcast((index.centres, index.radii))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, r = shared.value
        for b in (part for whole in batches for part in _slices(whole)):
            m = _vectors(b.column(1), b.num_rows)
            want = wanted(m, b.column(2).to_numpy(zero_copy_only=False).astype(np.float64), c, r)
            for g, lo, hi in of:
                at = np.flatnonzero(want[:, lo:hi].any(axis=1))
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), g, np.int32)), b.column(0).take(pa.array(at)),
                         _binary(m[at].astype(own)), _binary(np.packbits(want[at, lo:hi], axis=1))],
                        ["grp", "qid", "vec", "mask"])

    return asked.mapInArrow(visits, "grp int, qid long, vec binary, mask binary")


def _met(index: CellIndex, visits: DataFrame, q_own: str, queries: int, k: int, exclude_self: bool,
         pay: list[T.StructField]) -> DataFrame:
    """(qid, pid, score, cell, payload): the k best of each group of cells for
    each query that visits some of them. A group's blocks meet the queries about
    GROUP_ROWS at a time (``queries`` in all), so a task's memory depends neither
    on the tables nor on how many cells a query visits, and a query's vector
    travels once for each group, not for each cell."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = visits.sparkSession
    own = np.dtype(index.dtype)
    arrow = [to_arrow_type(f.dataType) for f in pay]
    before, first, last = _groups(index)
    cores = spark.sparkContext.defaultParallelism       # that few groups can keep busy, too
    parts = max(1, -(-queries // GROUP_ROWS), min(-(-2 * cores // int(last[-1] + 1)), -(-queries // BLOCK_ROWS)))
    names = ["qid", "pid", "score", "cell", *[f.name for f in pay]]
    schema = T.StructType([T.StructField("qid", T.LongType()), T.StructField("pid", T.LongType()),
                           T.StructField("score", T.DoubleType()), T.StructField("cell", T.IntegerType()), *pay])
    place = spark.createDataFrame([(c, int(before[c]), int(last[c])) for c in range(len(before))],
                                  "cell int, before long, last long")
    blocks = (spark.read.parquet(index.path).join(F.broadcast(place), "cell")
              .withColumn("grp", F.least(F.floor((F.col("before") + F.col("blk") * BLOCK_ROWS) / GROUP_ROWS), "last")
                          .cast("int"))
              .select("grp", "cell", "__id", "mat", *[f.name for f in pay])
              .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))))
    asked = visits.withColumn("part", F.pmod(F.xxhash64("qid"), F.lit(parts)).cast("int"))

    def matrix(col: pa.ChunkedArray, dtype) -> np.ndarray:
        return np.frombuffer(b"".join(x.as_buffer() for x in col), dtype).reshape(len(col), -1)

    def score(held: pa.Table, asking: pa.Table) -> pa.Table:
        if not held.num_rows or not asking.num_rows:
            return pa.table([pa.array([], f.type) for f in out], names)
        lo = int(np.argmax(last >= held["grp"][0].as_py()))         # the first cell of the mask
        mask = np.unpackbits(matrix(asking["mask"], np.uint8), axis=1).astype(bool)
        best = Best(asking["qid"].to_numpy(), matrix(asking["vec"], q_own), k, 1 + len(pay))
        for b in held.to_batches():
            for i in range(b.num_rows):
                cell = b.column("cell")[i].as_py()
                ids = b.column("__id")[i].values.to_numpy(zero_copy_only=False)
                mat = np.frombuffer(b.column("mat")[i].as_buffer(), own).reshape(len(ids), -1)
                values = [b.column(f.name)[i].values for f in pay]

                def some(rows, cell=cell, values=values):
                    at = pa.array(rows)
                    return [[cell] * len(rows), *[v.take(at).to_pylist() for v in values]]

                cols = np.flatnonzero(mask[:, cell - lo])
                if len(cols):
                    best.meet(ids, mat, some, cols, exclude_self)
        qid, pid, scores, found = best.found()
        return pa.table([pa.array(qid), pa.array(pid), pa.array(scores),
                         *[pa.array(list(x), f.type) for x, f in zip(found, out[3:])]], names)

    out = [pa.field(n, t) for n, t in zip(names, (pa.int64(), pa.int64(), pa.float64(), pa.int32(), *arrow))]
    return blocks.groupBy("grp", "part").cogroup(asked.groupBy("grp", "part")).applyInArrow(score, schema)


def recall(approximate: DataFrame, exact: DataFrame, query_id: str = "query_id",
           product_id: str = "product_id") -> DataFrame:
    """One row: n_queries, expected and found neighbours of the exact result, recall."""
    hit = approximate.select(query_id, product_id).withColumn("__hit", F.lit(1))
    j = exact.select(query_id, product_id).join(hit, [query_id, product_id], "left")
    return (j.agg(F.count_distinct(query_id).alias("n_queries"), F.count(F.lit(1)).alias("expected"),
                  F.count("__hit").alias("found"))
            .withColumn("recall", F.col("found") / F.col("expected")))


def scratch_path(spark: SparkSession) -> str:
    """A folder of its own for an index, in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/cells-{uuid.uuid4().hex}"
