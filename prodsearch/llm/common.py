"""Helpers shared by the operators: words, hashes, components."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodsearch.session import cut_lineage, ensure_checkpoint_dir

# A word is a maximal run of characters other than space and U+0009..U+000D.
SPACES = r"[\x20\x09-\x0D]+"

_C1 = np.uint64(0xBF58476D1CE4E5B9)
_C2 = np.uint64(0x94D049BB133111EB)
_C3 = np.uint64(0x9E3779B97F4A7C15)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often
    the body uses it (the optimizer may otherwise inline it into lambdas)."""
    return F.transform(F.array(value), body)[0]


def word_array(text: Column) -> Column:
    """The words of a text in order; no words for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler (splitmix finalizer), vectorized."""
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit keyed hash of each word, the same in every process."""
    if not words:
        return np.empty(0, np.uint64)
    return pd.util.hash_array(np.array(words, dtype=object), categorize=True)


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of n consecutive word hashes."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = h[:m].copy()
    for k in range(1, n):
        out = mix64(out * _C3 + h[k:k + m])
    return out


def text_words(text: str | None) -> list[bytes]:
    """Words as UTF-8, A-Z lower-cased (bytes methods touch ASCII only, and
    bytes.split() splits on exactly space and U+0009..U+000D)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hash_chunks(texts, max_words: int = 100_000) -> Iterator[tuple[int, np.ndarray]]:
    """(row position, word hashes) of each text. Texts are hashed together in
    chunks of about ``max_words`` words, so memory stays bounded and the
    per-call cost is shared; one text is never cut."""
    rows: list[tuple[int, int]] = []
    words: list[bytes] = []

    def flush():
        h, at = hash_words(words), 0
        for i, n in rows:
            yield i, h[at:at + n]
            at += n

    for i, t in enumerate(texts):
        w = text_words(t)
        rows.append((i, len(w)))
        words.extend(w)
        if len(words) >= max_words:
            yield from flush()
            rows, words = [], []
    yield from flush()


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(),
          "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(),
          "array<long>": pa.list_(pa.int64())}


def arrow_columns(fields: dict[str, str], values: dict) -> list[pa.Array]:
    return [pa.array(values[n], type=_ARROW[t]) for n, t in fields.items()]


#: what a Python worker keeps between tasks; a task that does not use it drops it
KEPT: dict = {}


def give_back() -> None:
    """Drop what earlier tasks kept and return freed memory to the system.
    Python workers live on between tasks and stages, and neither Arrow nor the
    C library gives back by itself what a task freed."""
    KEPT.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):       # not the GNU C library
        pass


PART_BYTES = 4 << 20        # of texts handed over together


def parts_of(b: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most PART_BYTES of text, or one row: Spark's
    batches count rows, and a copy of a batch of long texts as Python strings
    takes a multiple of it."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < b.num_rows:
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + PART_BYTES, side="right")))
        yield b.slice(at, to - at)
        at = to


def map_texts(df: DataFrame, keep: list[str], text: str, make, fields: dict[str, str],
              keeps_state: bool = False, arrow: bool = False) -> DataFrame:
    """Columns ``keep`` plus ``fields`` (name -> type), computed from the text
    batch by batch where it is read. ``make()`` is called once per task and
    returns a function from a list of texts (None for null) to a dict of
    lists, one value per text. Kept columns pass through as they are, so
    nulls and large numbers stay exact. A dict that holds ``at`` gives rows
    by position in the batch instead: none, one or several per text. With
    ``arrow`` the function gets the texts as an Arrow array; ``keeps_state``
    leaves what is in KEPT for the worker's next task.
    """
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps_state:
            give_back()
        of = make()
        for b in (p for whole in batches for p in parts_of(whole, n)):
            got = of(b.column(n) if arrow else b.column(n).to_pylist())
            held = b.columns[:n]
            if "at" in got:
                at = pa.array(got["at"], pa.int64())
                held = [c.take(at) for c in held]
            yield pa.RecordBatch.from_arrays(
                held + arrow_columns(fields, got), [*keep, *fields])

    kept = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    schema = ", ".join(kept + [f"`{c}` {t}" for c, t in fields.items()])
    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`")).mapInArrow(run, schema)


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Connected components of (a, b) links: one row (node, comp) per node
    that has a link, comp the smallest node reachable.

    Alternating large-star / small-star rounds: every round is two grouped
    minima over the edges, so nothing is gathered per component, and each
    round's edges are checkpointed to the shared folder. A hub's edges are
    joined back on the node, which AQE may split. Null ends and self links
    are ignored; no links gives no rows.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    e = (edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = cut_lineage(e)
    before = None
    for _ in range(max_rounds):
        # large star: every larger neighbour of n links to the smallest of n and its neighbours
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # a table of its own, so that AQE may split a hub's edges in the join
        low = cut_lineage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: n and its smaller neighbours link to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        e = cut_lineage(small)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    else:
        raise RuntimeError(f"links did not settle in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(roots)
