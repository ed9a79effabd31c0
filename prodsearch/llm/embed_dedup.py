"""Embedding near-dedup by a random-projection tree forest.

Each tree splits the vectors by random directions at medians; vectors within
a margin of the split go to both sides (spill), so near vectors seldom part.
Only vectors that share a leaf of some tree are compared, in double
precision, and links found in any tree are united.

The split values are fitted on a sample that grows with the number of vectors,
a tree per task, and every vector is routed down to its leaves where it is
read; a group of neighbouring leaves is compared in one task. A leaf over the
size of a group (a mass of near-equal vectors) is cut into blocks, and each
pair of blocks is a task. The first leaf that holds both ends of a pair owns
it, so tasks return a number of links per vector and links that span their
components, never pairs. Equal vectors are one point with a weight, so a mass
of copies is one row.

With margin M = 0.5 and 8 trees a pair at the threshold parts in all trees
with a probability of about 1e-6 (see ``spill``); recall is measured against
brute force in the tests.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths are not compared;
a null id counts as no id; repeated rows are further vectors; an empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodsearch.llm.common import components
from prodsearch.session import cut_lineage

COSINE = 0.95
TREES = 8
MARGIN = 0.5                # spill half-width in typical projected distances at the threshold
SAMPLE = 20_000             # vectors the trees are fitted on, at least; SAMPLE_LEAF for each leaf
SAMPLE_LEAF = 8
GROUP = 4_096               # expected vectors of a tree's group; a larger leaf is cut into blocks
LEAF = 256                  # expected vectors of a leaf, which sets the depth
SEED = 11


def spill(dim: int, cosine: float = COSINE, margin: float = MARGIN) -> float:
    """Half-width of the overlap. A pair at the threshold lies sqrt(2 - 2 cos)
    apart, about that over sqrt(dim) along a random direction; both must lie
    farther than the half-width from a split, on opposite sides, to part."""
    return margin * np.sqrt((2 - 2 * cosine) / dim)


def directions(dim: int, tree: int, levels: int) -> np.ndarray:
    """A unit direction for each level of a tree, as columns. The nodes of a
    level share it: a pair meets one node of a level at most."""
    v = np.random.default_rng([SEED, tree]).normal(size=(max(1, levels), dim))[:levels]
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).T


def fit_tree(p: np.ndarray) -> np.ndarray:
    """Split values in heap order from 1, medians of the sample's projections
    (a column per level); 0 for nodes the sample does not reach."""
    at = np.zeros(1 << p.shape[1])
    node = np.ones(len(p), np.int64)
    for level in range(p.shape[1]):
        order = np.lexsort((p[:, level], node))
        found, first, n = np.unique(node[order], return_index=True, return_counts=True)
        own = p[order, level]
        at[found] = (own[first + (n - 1) // 2] + own[first + n // 2]) / 2
        node = 2 * node + (p[:, level] > at[node])
    return at


def route(p: np.ndarray, at: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows, leaves) by the projections, spilled rows in both sides."""
    rows, node = np.arange(len(p)), np.ones(len(p), np.int64)
    for level in range(p.shape[1]):
        d = p[rows, level] - at[node]
        low, high = d <= width, d > -width
        rows = np.concatenate([rows[low], rows[high]])
        node = np.concatenate([2 * node[low], 2 * node[high] + 1])
    return rows, node


TREE = 1 << 40              # a place is tree * TREE + leaf


def places(x: np.ndarray, fitted: list[np.ndarray], width: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows, places) over all trees, by place."""
    rows, at = [], []
    for t, split in enumerate(fitted):
        r, leaf = route(x @ directions(x.shape[1], t, len(split).bit_length() - 1), split, width)
        rows.append(r)
        at.append(t * TREE + leaf)
    rows, at = np.concatenate(rows), np.concatenate(at)
    order = np.argsort(at, kind="stable")
    return rows[order], at[order]


def owned(x: np.ndarray, left: np.ndarray, right: np.ndarray, rows: np.ndarray, at: np.ndarray,
          cosine: float) -> np.ndarray:
    """Which pairs of two blocks (the same block: each pair once) reach the
    cosine and share none of the places ``at`` of ``rows``, all before theirs."""
    same = left is right
    here = np.zeros(len(x), bool)
    here[left] = here[right] = True
    kept = here[rows]
    rows, at = rows[kept], at[kept]
    # pairs inside the earlier place that holds most of both blocks need no product
    met = np.zeros(len(x), bool)
    if len(at):
        found, n = np.unique(at, return_counts=True)
        met[rows[at == found[np.argmax(n)]]] = True
    out = np.zeros((len(left), len(right)), bool)
    free, new = np.nonzero(~met[left])[0], np.nonzero(~met[right])[0]
    for s in range(0, len(free), 1024):
        f = free[s:s + 1024]
        out[f] = x[left[f]] @ x[right].T >= cosine
    old = np.nonzero(met[left])[0]
    for s in range(0, len(old) if len(new) else 0, 1024):
        f = old[s:s + 1024]
        out[np.ix_(f, new)] = x[left[f]] @ x[right[new]].T >= cosine
    if same:
        out = np.triu(out, 1)
    if not out.any():
        return out
    # of the linked rows, drop the pairs that an earlier place holds
    row, col = np.full(len(x), -1), np.full(len(x), -1)
    i, j = np.nonzero(out.any(axis=1))[0], np.nonzero(out.any(axis=0))[0]
    row[left[i]], col[right[j]] = i, j
    cuts = np.nonzero(np.diff(at))[0] + 1
    for members in np.split(rows, cuts):
        r, c = row[members], col[members]
        r, c = r[r >= 0], c[c >= 0]
        if len(r) and len(c):
            out[np.ix_(r, c)] = False
    return out


def spanning(pairs: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(row, rows it is connected with): stars that span the pairs' components."""
    out = []
    seen_l, seen_r = ~pairs.any(axis=1), np.zeros(len(right), bool)
    for s in range(len(left)):
        if seen_l[s]:
            continue
        seen_l[s] = True
        front = np.array([s])
        while len(front):
            r = np.nonzero(pairs[front].any(axis=0) & ~seen_r)[0]
            seen_r[r] = True
            front = np.nonzero(pairs[:, r].any(axis=1) & ~seen_l)[0]
            seen_l[front] = True
            out.append((left[s], np.concatenate([right[r], left[front]])))
    return out


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v, key): the vectors that may link, as doubles, with a hash
    that names equal ones."""
    v = F.col(f"`{embedding}`").cast("array<double>")
    fine = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))),
                      F.lit(False))
    return (vectors.where(fine & F.exists(v, lambda x: x != 0))
            .select(F.col(f"`{vec_id}`").alias("vec_id"), v.alias("v"), F.xxhash64(v).alias("key")))


def _unit(column) -> np.ndarray:
    x = np.array(column.to_pylist(), dtype=np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)        # no overflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def point_links(points: DataFrame, dim: int, cosine: float = COSINE, trees: int = TREES) -> DataFrame:
    """Of the points (key, v, copies) that link: (a, others) with a number of
    linked vectors, to be summed by a, and (a, b) that span the components."""
    spark = points.sparkSession
    n = points.count()
    block = GROUP
    levels = max(0, int(np.ceil(np.log2(max(1, n) / LEAF))))
    below = min(levels, max(0, int(np.log2(max(1, GROUP // LEAF)))))    # levels inside a group
    width = spill(dim, cosine)
    fitted = [np.zeros(1) for _ in range(trees)]
    if levels:
        wanted = max(SAMPLE, SAMPLE_LEAF << levels)
        per_million = max(1, min(1_000_000, wanted * 1_000_000 // n))

        def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    x = _unit(b.column("v"))
                    for t in range(trees):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([t] * len(x), pa.int32()),
                             pa.array(list(x @ directions(dim, t, levels)), pa.list_(pa.float64()))], ["tree", "p"])

        def fit(tree: pa.Table) -> pa.Table:
            at = fit_tree(tree["p"].combine_chunks().flatten().to_numpy().reshape(-1, levels))
            return pa.table({"tree": tree["tree"][:1], "at": pa.array([at], pa.list_(pa.float64()))})

        sample = points.where(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < per_million).select("v")
        for r in (sample.mapInArrow(project, "tree int, p array<double>").groupBy("tree")
                  .applyInArrow(fit, "tree int, at array<double>").collect()):
            fitted[r["tree"]] = np.array(r["at"])
        fitted = [f if len(f) > 1 else np.zeros(1 << levels) for f in fitted]
    shared = spark.sparkContext.broadcast(fitted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                at, m = np.unique(places(_unit(b.column("v")), shared.value, width)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(m)], ["place", "m"])

    sizes = (points.select("v").mapInArrow(count, "place long, m long").groupBy("place")
             .agg(F.sum("m").alias("m")).where(F.col("m") > block).collect()) if n > block else []
    # the leaves over a group's size, with their numbers of blocks
    large = spark.sparkContext.broadcast({r["place"]: -(-r["m"] // block) for r in sizes})

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(sorted(large.value), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            b = b.select(["key", "copies", "v"])
            key = b.column("key").to_numpy().astype(np.uint64)
            rows, at = places(_unit(b.column("v")), shared.value, width)
            over = np.isin(at, names)
            tree, leaf = at[~over] // TREE, at[~over] % TREE
            small = np.unique(np.stack([tree * TREE + (leaf >> below), rows[~over]]), axis=1)
            parts = [(small[1], small[0], np.full(small.shape[1], -1), np.full(small.shape[1], -1))]
            for place in np.unique(at[over]):
                own, k = rows[at == place], large.value[place]
                mine = (key[own] % np.uint64(k)).astype(np.int64)
                parts += [(own, np.full(len(own), place), np.minimum(mine, j), np.maximum(mine, j)) for j in range(k)]
            for r, grp, i, j in parts:
                for s in range(0, len(r), 10_000):
                    e = slice(s, s + 10_000)
                    part = b.take(pa.array(r[e]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(grp[e], pa.int64()), pa.array(i[e], pa.int64()), pa.array(j[e], pa.int64()),
                         *part.columns], ["grp", "i", "j", "key", "copies", "v"])

    def compare(group: pa.Table) -> pa.Table:
        x, key, copies = _unit(group["v"]), group["key"].to_numpy(), group["copies"].to_numpy()
        grp, i, j = (group[c][0].as_py() for c in ("grp", "i", "j"))
        rows, at = places(x, shared.value, width)
        if i >= 0:
            mine = key.astype(np.uint64) % np.uint64(large.value[grp])
            left = np.nonzero(mine == i)[0]
            todo = [(grp, left, left if i == j else np.nonzero(mine == j)[0])]
        else:
            own = (at // TREE == grp // TREE) & ((at % TREE) >> below == grp % TREE)
            todo = []
            for place in np.unique(at[own]):
                if place not in large.value:
                    left = rows[at == place]
                    todo.append((place, left, left))
        others = np.zeros(len(x))
        a, b = [], []
        for place, left, right in todo:
            before = at.searchsorted(place)
            pairs = owned(x, left, right, rows[:before], at[:before], cosine)
            if pairs.any():
                ones = pairs.astype(np.float64)
                others[left] += ones @ copies[right]
                others[right] += ones.T @ copies[left]
                for one, more in spanning(pairs, left, right):
                    a.append(np.full(len(more), key[one]))
                    b.append(key[more])
        some = np.nonzero(others)[0]
        a, b = (np.concatenate(c) if c else np.empty(0, np.int64) for c in (a, b))
        return pa.table({
            "a": pa.array(np.concatenate([key[some], a]), pa.int64()),
            "b": pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(b, pa.int64())]),
            "others": pa.concat_arrays([pa.array(others[some].astype(np.int64)), pa.nulls(len(a), pa.int64())])})

    spread_out = points.select("key", "copies", "v").mapInArrow(
        spread, "grp long, i long, j long, key long, copies long, v array<double>")
    return spread_out.groupBy("grp", "i", "j").applyInArrow(compare, "a long, b long, others long")


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                    cosine: float = COSINE, trees: int = TREES) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links (other vectors linked directly),
    component_id (smallest id reachable) and kept (the id is that one)."""
    fine = usable(vectors, vec_id, embedding)
    points = cut_lineage(fine.groupBy("key").agg(
        F.first("v").alias("v"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least")))
    dims = sorted(r[0] for r in points.select(F.size("v")).distinct().collect())
    links = None
    for dim in dims:
        found = point_links(points.where(F.size("v") == dim), dim, cosine, trees)
        links = found if links is None else links.union(found)
    if links is None:
        links = vectors.sparkSession.createDataFrame([], "a long, b long, others long")
    links = cut_lineage(links)
    linked = links.where("others IS NOT NULL").groupBy(F.col("a").alias("key")).agg(F.sum("others").alias("others"))
    comps = components(links.select("a", "b")).select(F.col("node").alias("key"), "comp")
    placed = (points.drop("v").join(linked, "key", "left").join(comps, "key", "left")
              .withColumn("comp", F.coalesce("comp", "key")))
    least = placed.groupBy("comp").agg(F.min("least").alias("component_id"))
    facts = placed.join(least, "comp").select(
        "key", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = (vectors.select(F.col(f"`{vec_id}`").alias("vec_id"),
                          F.xxhash64(F.col(f"`{embedding}`").cast("array<double>")).alias("key"))
           .join(facts, "key", "left"))
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
