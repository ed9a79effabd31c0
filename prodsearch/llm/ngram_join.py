"""N-gram Jaccard join by vertical partitioning.

A document's set holds the hashes of its distinct word n-grams; the global
order of n-grams is the order of their hashes, so all documents' sets are cut
at the same places into fragments.

1. Documents with equal sets are one node; copies never meet each other.
2. Candidates. Sets of similar size that reach the threshold differ in at most
   D n-grams. Cut into more than D non-empty fragments, two such sets agree
   on one of them entirely. So nodes that share a whole fragment are the
   only candidates; n-grams found to be common are left out of fragments, so
   that passages many documents quote make hardly any, and pairs whose
   sketches (a byte of each of 128 fragments) rule them out are dropped.
   Nothing is capped. Nodes connected by candidates form a candidate group.
3. Verification. A group's sets meet in one task, or, beyond BLOCK_NODES
   members or BLOCK_GRAMS n-grams, block by block in several. The overlaps of
   all pairs are counted fragment by fragment of the global order, as matrix
   products, and summed per pair; the sums decide. A task returns links that
   connect what it found linked, at most one per node, never the pairs.
   Components are exact.

64-bit hashes stand for n-grams; a collision inside a compared pair needs
about 2^32 n-grams.

Defined cases: null, empty and blank texts have an empty set and link with
nothing; a text with fewer words than n is one n-gram; rows with equal texts
share a component, also under one id; a null id counts as no id; an empty
table gives an empty table; only the id and the text are read.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodsearch.llm.common import components, give_back, gram_hashes, map_texts, mix64, parts_of, word_hash_chunks
from prodsearch.operators.guard import broadcast_if_small
from prodsearch.session import cut_lineage

GRAM_WORDS = 4
THRESHOLD = 85              # 100 * intersection >= THRESHOLD * union
BLOCK_NODES = 2_048         # nodes of a candidate group compared in one task
BLOCK_GRAMS = 2_000_000     # and their n-grams
SKETCH = 128
PAIR_NODES = 32             # fragments with so many nodes or fewer give pairs, others a star
COMMON_SAMPLE = 4_000       # documents (expected) that common n-grams are found in
COMMON_IN = 4               # an n-gram in so many of them is common
FRAGMENT_GRAMS = 4_096      # distinct n-grams of the fragments overlaps are counted in
BUCKET_ENTRIES = 200_000    # expected fragment signatures sorted together by one task
MAX_BROADCAST_NODES = 1_000_000


def gram_set(word_hashes: np.ndarray, n: int = GRAM_WORDS) -> np.ndarray:
    """Sorted distinct n-gram hashes; a shorter sequence is one n-gram."""
    if len(word_hashes) == 0:
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(word_hashes, min(n, len(word_hashes))))


def node_of(grams: np.ndarray) -> int:
    """64-bit name of a set."""
    with np.errstate(over="ignore"):
        return int(mix64(np.array([mix64(grams).sum(dtype=np.uint64) + np.uint64(len(grams))]))
                   .view(np.int64)[0])


def sketch_of(grams: np.ndarray) -> bytes:
    """A byte for each of SKETCH fragments of the global order: a hash of the
    smallest n-gram there, 0 where there is none."""
    place = (grams >> np.uint64(32)) * np.uint64(SKETCH) >> np.uint64(32)
    starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    out = np.zeros(SKETCH, np.uint8)
    out[place[starts].astype(np.int64)] = 1 + mix64(grams[starts]) % np.uint64(255)
    return out.tobytes()


def far_apart(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray,
              threshold: int) -> np.ndarray:
    """Whether pairs with these sketches stay below the threshold. Sets that
    reach it differ in D n-grams at most, and each changes one fragment: more
    differing fragments rule a pair out. Of 110 and more filled fragments at
    most a share of 1 - threshold differs on average; over 55 % have a chance
    below 1e-14 at 0.8 (1e-9 at 0.75; lower thresholds use the bound alone)."""
    differ = (a != b).sum(axis=1)
    filled = ((a > 0) | (b > 0)).sum(axis=1)
    far = differ > (100 - threshold) * (size_a + size_b) // (100 + threshold)
    return far | ((filled >= 110) & (differ > 0.55 * filled)) if threshold >= 75 else far


class SizeClasses:
    """Size classes and the number of fragments each is cut into.

    Class c holds sizes from low[c] up to low[c + 1] - 1, and a set of class
    c can only reach the threshold with sizes of class c and c + 1. A pair
    meets in the class of its smaller set, so a set is cut for its own class
    and for the one below.
    """

    def __init__(self, threshold: int = THRESHOLD):
        self.threshold = threshold
        self.low = [1]
        self.fragments: list[int] = []
        self.differences: list[int] = []

    def _grow(self, size: int) -> None:
        t = self.threshold
        while self.low[-1] <= size:
            low = self.low[-1]
            top = max(low + 1, -(-low * 100 // t))
            self.low.append(top)
            # 100 i >= t u with i = (s - d) / 2 and u = (s + d) / 2 for the sum s of both sizes
            s = (top - 1) + (top - 1) * 100 // t
            d = (100 - t) * s // (100 + t)
            self.differences.append(d)
            self.fragments.append(self._enough(low, d) if d else 0)

    @staticmethod
    def _enough(low: int, d: int) -> int:
        """Fragments so that a set of the smallest size fills more than d of
        them but for bad luck (three standard deviations)."""
        k = d + 2
        while k < 2 * (d + 2):
            empty = k * math.exp(-low / k)
            if k - empty - 3 * math.sqrt(empty) >= d + 1:
                break
            k += 1 + d // 200
        return k

    def of(self, size: int) -> list[tuple[int, int, int]]:
        """(class, fragments, largest difference) of the classes to cut for.
        A class in which only equal sets reach the threshold needs no cut."""
        self._grow(size)
        c = bisect_right(self.low, size) - 1
        return [(k, self.fragments[k], self.differences[k]) for k in (c, c - 1)
                if k >= 0 and self.fragments[k]]


def fragment_hashes(grams: np.ndarray, k: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the filled ones of k fragments; ``base`` names the cut."""
    if not len(grams):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    place = ((grams >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
    starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    content = np.add.reduceat(mix64(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts)
    return place[starts], mix64(content ^ mix64(np.uint64(base) + place[starts]))


def signatures(grams: np.ndarray, classes: SizeClasses, common: np.ndarray) -> np.ndarray:
    """One hash for each filled fragment of a set, in each class it is cut for.

    Common n-grams are left out first: what two sets differ in can only
    shrink by that, so a shared fragment stays sure, and a passage that many
    documents quote fills none. A set with too few filled fragments then (D or
    less) adds the fragments of all its n-grams, and if these are too few as
    well, the empty ones. Of two sets that reach the threshold either one has
    more than D filled fragments, and the other agrees on one of them, or
    both add all fragments.
    """
    rare = grams
    if len(common):
        at = np.minimum(np.searchsorted(common, grams), len(common) - 1)
        rare = grams[common[at] != grams]
    out = [np.empty(0, np.uint64)]
    for c, k, d in classes.of(len(grams)):
        _, own = fragment_hashes(rare, k, c << 40)
        out.append(own)
        if len(own) <= d:
            base = (c << 40) + (1 << 39)
            place, own = fragment_hashes(grams, k, base)
            out.append(own)
            if len(own) <= d:
                empty = np.setdiff1d(np.arange(k, dtype=np.uint64), place)
                out.append(mix64(mix64(np.uint64(base) + empty)))
    return np.concatenate(out)


def common_grams(rows: DataFrame, nodes: DataFrame, n: int, sample: int = COMMON_SAMPLE,
                 share: int = COMMON_IN) -> np.ndarray:
    """Sorted n-grams that at least ``share`` of about ``sample`` documents
    with different sets hold. A bounded sample, as it decides only which
    candidates are met, never which links are found."""
    total = nodes.count()
    per_million = max(1, min(1_000_000, sample * 1_000_000 // max(1, total)))
    picked = rows.where(F.pmod(F.xxhash64("thash"), F.lit(1_000_000)) < per_million)

    def make():
        def of(texts: list) -> dict:
            out = {"at": [], "node": [], "gram": []}
            for i, h in word_hash_chunks(texts):
                g = gram_set(h, n)
                if len(g):
                    out["at"].extend([i] * len(g))
                    out["node"].extend([node_of(g)] * len(g))
                    out["gram"].extend(g.view(np.int64).tolist())
            return out
        return of

    grams = map_texts(picked, [], "text", make, {"node": "long", "gram": "long"}).distinct()
    # at most the sample's n-grams divided by ``share`` reach the driver
    got = grams.groupBy("gram").count().where(F.col("count") >= share).select("gram").toArrow()
    return np.sort(got["gram"].to_numpy().view(np.uint64))


def slim(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, thash, text); id and text hash name a row up to exact repeats."""
    t = F.col(f"`{text}`")
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(t).alias("thash"), t.alias("text"))


def node_table(rows: DataFrame, n: int) -> DataFrame:
    """Per row of ``slim``: doc_id, thash, n_shingles, node and sketch (null for
    an empty set)."""
    def make():
        def of(texts: list) -> dict:
            size, node, sketch = [0] * len(texts), [None] * len(texts), [None] * len(texts)
            for i, h in word_hash_chunks(texts):
                g = gram_set(h, n)
                if len(g):
                    size[i], node[i], sketch[i] = len(g), node_of(g), sketch_of(g)
            return {"n_shingles": size, "node": node, "sketch": sketch}
        return of

    return map_texts(rows, ["doc_id", "thash"], "text", make,
                     {"n_shingles": "long", "node": "long", "sketch": "binary"})


def candidate_edges(rows: DataFrame, n: int, threshold: int, grams: int, common: np.ndarray) -> DataFrame:
    """(a, b, star): the nodes that share a fragment with another. A fragment
    of few nodes gives all their pairs; a fragment of many links each with
    the smallest (``star``), which stands for the pairs it does not list.

    Signatures travel in blocks by bucket of their hash, each node's once per
    task, and are sorted bucket by bucket; bucket sizes follow ``grams``.
    """
    buckets = max(1, grams // (3 * BUCKET_ENTRIES) + 1)
    shared = rows.sparkSession.sparkContext.broadcast(common)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        classes, seen, known = SizeClasses(threshold), set(), shared.value
        held: list[tuple[np.ndarray, int]] = []
        size = 0

        def blocks():
            sig = np.concatenate([s for s, _ in held])
            node = np.repeat(np.array([x for _, x in held], np.int64), [len(s) for s, _ in held])
            to = (sig % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(to, kind="stable")
            sig, node, to = sig[order], node[order], to[order]
            edge = np.flatnonzero(np.r_[True, to[1:] != to[:-1], True])
            part = list(zip(edge, edge[1:]))
            return pa.RecordBatch.from_arrays(
                [pa.array([int(to[a]) for a, _ in part], pa.int32()),
                 pa.array([sig[a:z].tobytes() for a, z in part], pa.binary()),
                 pa.array([node[a:z].tobytes() for a, z in part], pa.binary())],
                ["bucket", "sigs", "nodes"])

        for b in (p for whole in batches for p in parts_of(whole, 0)):
            for _, h in word_hash_chunks(b.column(0).to_pylist()):
                g = gram_set(h, n)
                if not len(g):
                    continue
                node = node_of(g)
                if node in seen:
                    continue
                seen.add(node)
                s = signatures(g, classes, known)
                if len(s):
                    held.append((s, node))
                    size += len(s)
                if size >= 1_000_000:
                    yield blocks()
                    held, size = [], 0
        if held:
            yield blocks()
        held.clear()
        seen.clear()
        give_back()

    def meet(group: pa.Table) -> pa.Table:
        sig = np.concatenate([np.frombuffer(x, np.uint64) for x in group["sigs"].to_pylist()])
        node = np.concatenate([np.frombuffer(x, np.int64) for x in group["nodes"].to_pylist()])
        order = np.lexsort((node, sig))
        sig, node = sig[order], node[order]
        first = np.r_[True, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])]
        sig, node = sig[first], node[first]
        starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]]) if len(sig) else np.empty(0, np.int64)
        counts = np.diff(np.r_[starts, len(sig)])
        many = counts > PAIR_NODES
        held = np.repeat(many, counts)
        stars = np.stack([np.repeat(node[starts], counts)[held], node[held]], axis=1)
        pairs = [np.empty((0, 2), np.int64)]
        for k in np.unique(counts[(counts > 1) & ~many]):
            i, j = np.triu_indices(int(k), 1)
            at = starts[counts == k][:, None]
            pairs.append(np.stack([node[at + i].ravel(), node[at + j].ravel()], axis=1))
        pairs = np.unique(np.concatenate(pairs), axis=0)
        stars = np.unique(stars[stars[:, 0] != stars[:, 1]], axis=0)
        both = np.concatenate([pairs, stars])
        out = pa.table({"a": both[:, 0], "b": both[:, 1],
                        "star": np.repeat([False, True], [len(pairs), len(stars)])})
        del sig, node, order, first, held
        give_back()
        return out

    blocks = rows.select("text").mapInArrow(cut, "bucket int, sigs binary, nodes binary")
    return blocks.groupBy("bucket").applyInArrow(meet, "a long, b long, star boolean").distinct()


def plausible(edges: DataFrame, nodes: DataFrame, threshold: int) -> DataFrame:
    """(a, b): ``edges`` without the pairs whose sketches rule them out. Links
    of a star stay, as they stand for others."""
    one = nodes.where("node IS NOT NULL").select("node", "n_shingles", "sketch").dropDuplicates(["node"])
    sides = [one.select(F.col("node").alias(c), F.col("n_shingles").alias(f"size_{c}"),
                        F.col("sketch").alias(f"sketch_{c}")) for c in ("a", "b")]
    joined = edges.where("NOT star").join(sides[0], "a").join(sides[1], "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if not x.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(x.column(f"sketch_{c}").to_pylist()), np.uint8)
                    .reshape(x.num_rows, SKETCH) for c in ("a", "b"))
            size_a, size_b = (x.column(f"size_{c}").to_numpy() for c in ("a", "b"))
            near = pa.array(~far_apart(a, b, size_a, size_b, threshold))
            yield pa.RecordBatch.from_arrays([x.column("a").filter(near), x.column("b").filter(near)], ["a", "b"])

    return joined.mapInArrow(run, "a long, b long").union(edges.where("star").select("a", "b"))


def overlaps(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """The overlap of every pair of sets (of two lists): partial overlaps of
    one fragment of the global order after the other, summed."""
    sets = left if right is None else left + right
    grams = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    starts = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
    counts = np.diff(np.r_[starts, len(grams)])
    shared = np.repeat(counts > 1, counts)
    # numbers of the n-grams that more than one set holds, in global order
    place = (np.cumsum(counts > 1) - 1).repeat(counts)[shared]
    owner = owner[shared]
    kind = np.float32 if max(map(len, sets)) < 1 << 24 else np.float64
    out = np.zeros((len(left), len(sets) - len(left) if right is not None else len(left)), kind)
    for lo in range(0, int(place[-1]) + 1 if len(place) else 0, FRAGMENT_GRAMS):
        a, z = np.searchsorted(place, [lo, lo + FRAGMENT_GRAMS])
        held = np.zeros((int(place[z - 1]) - lo + 1, len(sets)), kind)
        held[place[a:z] - lo, owner[a:z]] = 1
        out += held[:, :len(left)].T @ (held if right is None else held[:, len(left):])
    return out


def spanning_links(links: np.ndarray) -> list[tuple[int, int]]:
    """(row, column) positions that connect what a link matrix connects: each
    row and column once at most, by breadth-first search."""
    out = []
    rows_left, cols_left = np.ones(links.shape[0], bool), np.ones(links.shape[1], bool)
    for first in range(links.shape[0]):
        if not rows_left[first]:
            continue
        rows_left[first] = False
        todo = [first]
        while todo:
            r = todo.pop()
            for c in np.flatnonzero(links[r] & cols_left):
                cols_left[c] = False
                out.append((r, int(c)))
                for x in np.flatnonzero(links[:, c] & rows_left):
                    rows_left[x] = False
                    out.append((int(x), int(c)))
                    todo.append(int(x))
    return out


def reached(same: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: int) -> np.ndarray:
    same = same.astype(np.int64)
    return 100 * same >= threshold * (left[:, None] + right[None, :] - same)


def compare_blocks(sized: DataFrame, n: int, threshold: int) -> DataFrame:
    """(a, b) links connecting what links within each task's groups. sized:
    (grp, comp, node, blk, text); a group in blocks has at most two of them in
    a task and compares across, or one and compares within."""
    def make():
        def of(texts: list) -> dict:
            out = [b""] * len(texts)
            for i, h in word_hash_chunks(texts):
                out[i] = gram_set(h, n).tobytes()
            return {"grams": out}
        return of

    sets = map_texts(sized, ["grp", "comp", "node", "blk"], "text", make, {"grams": "binary"})

    def meet(group: pa.Table) -> pa.Table:
        node, comp, blk = (group[c].to_numpy() for c in ("node", "comp", "blk"))
        order = np.lexsort((node, blk, comp))
        held = group["grams"]
        a, b = [], []
        for rows in np.split(order, np.flatnonzero(np.diff(comp[order])) + 1):
            # a node read from several equal rows counts once
            rows = rows[np.r_[True, node[rows][1:] != node[rows][:-1]]]
            parts = [[int(r) for r in rows[blk[rows] == k]] for k in np.unique(blk[rows])]
            grams = [[np.frombuffer(held[r].as_buffer(), np.uint64) for r in p] for p in parts]
            size = [np.array([len(g) for g in p]) for p in grams]
            z = len(parts) - 1
            same = overlaps(grams[0], grams[1] if z else None)
            links = reached(same, size[0], size[z], threshold)
            for r, c in spanning_links(links):
                if parts[0][r] != parts[z][c]:
                    a.append(int(node[parts[0][r]]))
                    b.append(int(node[parts[z][c]]))
            del grams, same, links
            give_back()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return sets.groupBy("grp").applyInArrow(meet, "a long, b long")


def node_components(rows: DataFrame, nodes: DataFrame, n: int, threshold: int,
                    block_nodes: int = BLOCK_NODES, block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """(node, comp) of the nodes that link with another; ``nodes`` is the
    checkpointed node table of ``rows``."""
    grams = nodes.agg(F.sum("n_shingles")).first()[0] or 0
    common = common_grams(rows, nodes, n)
    edges = cut_lineage(candidate_edges(rows, n, threshold, int(grams), common))
    near = cut_lineage(components(plausible(edges, nodes, threshold)))
    # one row of each node gives its set
    name = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "thash")
    single = (nodes.where("node IS NOT NULL").groupBy("node", F.col("n_shingles").alias("size"))
              .agg(F.min(name).alias("r")).join(near, "node"))
    sizes = single.groupBy("comp").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / block_nodes), F.ceil(F.sum("size") / block_grams)).alias("blks"))
    holders = cut_lineage(single.join(sizes, "comp").select(
        "node", "comp", "size", F.col("blks").cast("long").alias("blks"),
        F.col("r.doc_id").alias("id"), F.col("r.thash").alias("th")))
    total = holders.where("blks = 1").agg(F.sum("size")).first()[0] or 0
    buckets = int(total) // block_grams * 2 + 1
    held = rows.join(broadcast_if_small(holders, MAX_BROADCAST_NODES),
                     (F.col("thash") == F.col("th")) & F.col("doc_id").eqNullSafe(F.col("id")))
    blk = F.pmod(F.xxhash64("node"), F.col("blks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blks") - 1))
    small = F.concat(F.lit("s"), F.pmod(F.xxhash64("comp"), F.lit(buckets)).cast("string"))
    large = F.concat_ws(":", F.lit("l"), "comp", F.least("blk", "other"), F.greatest("blk", "other"))
    sized = (held.withColumn("blk", blk).withColumn("other", other)
             .withColumn("grp", F.when(F.col("blks") == 1, small).otherwise(large))
             .select("grp", "comp", "node", "blk", "text"))
    return components(compare_blocks(sized, n, threshold))


def cluster(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = GRAM_WORDS,
            threshold: int = THRESHOLD, **blocks) -> DataFrame:
    """Per row of ``docs``: doc_id, thash (of its text), n_shingles, comp (a
    number of its component, null for an empty set) and component_id, the
    smallest id reachable by links (its own included)."""
    rows = slim(docs, doc_id, text)
    nodes = cut_lineage(node_table(rows, n))
    comps = node_components(rows, nodes, n, threshold, **blocks)
    placed = nodes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = placed.where("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("least"))
    return (placed.join(least, "comp", "left")
            .select("doc_id", "thash", "n_shingles", "comp",
                    F.coalesce("least", "doc_id").alias("component_id")))


def without_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = GRAM_WORDS,
                        threshold: int = THRESHOLD) -> DataFrame:
    """One row of each group of near copies, that with the smallest id; rows
    without words stay. The columns of ``docs`` only."""
    c = cut_lineage(cluster(docs, doc_id, text, n, threshold).where("comp IS NOT NULL"))
    name = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "thash")
    first = c.groupBy("comp").agg(F.min(name).alias("first"))
    gone = (c.select("comp", name.alias("name")).join(first, "comp").where(F.col("name") != F.col("first"))
            .select(F.col("name.doc_id").alias("__id"), F.col("name.thash").alias("__th")).distinct())
    kept = docs.join(broadcast_if_small(gone, MAX_BROADCAST_NODES),
                     (F.xxhash64(F.col(f"`{text}`")) == F.col("__th"))
                     & F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")), "left_anti")
    # rows that repeat the kept one exactly; the texts are shuffled only if there are any
    repeats = (c.join(first, "comp").where(name == F.col("first")).groupBy("comp").count()
               .where("count > 1"))
    if repeats.isEmpty():
        return kept
    words = F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]")) > 0
    return (kept.withColumns({"__t": F.xxhash64(F.col(f"`{text}`")), "__w": F.when(
        words, F.lit(0)).otherwise(1 + F.monotonically_increasing_id())})
        .dropDuplicates([doc_id, "__t", "__w"]).drop("__t", "__w"))
