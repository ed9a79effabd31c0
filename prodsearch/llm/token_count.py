"""Token counts by a map-side two-tier lookup.

First tier: a compact table of the lengths of frequent chunks (words with
their space), fitted on a bounded sample of documents and broadcast. Second
tier: each worker's bounded cache, filled by the tokenizer. Every document
is counted where it is read; no chunk is shuffled.

Defined cases: a null or empty text has 0 bytes and 0 tokens; special
strings count as the library counts them; repeated rows are counted alike;
an empty table gives an empty table; only the columns asked for are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodsearch.llm.common import map_texts
from prodsearch.llm.pretokens import encoder, lines_of_chunks

SAMPLE_DOCS = 3_000         # about so many documents fit the table, whatever the input's size
TABLE_CHUNKS = 50_000       # entries of the broadcast table: about 1 MB
MAX_TABLE_CHARS = 24        # longer chunks are left to the caches
LIMIT = 1024


def frequent_chunks(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                    sample_docs: int = SAMPLE_DOCS, size: int = TABLE_CHUNKS) -> list[str]:
    """The chunks most frequent in a sample of documents by a hash of the id;
    at most ``size`` strings of MAX_TABLE_CHARS characters reach the driver."""
    n = docs.count()
    if n == 0:
        return []
    per_million = max(1, min(1_000_000, sample_docs * 1_000_000 // n))
    sample = docs.where(F.pmod(F.xxhash64(doc_id), F.lit(1_000_000)) < per_million).select(text)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                c.update(x for line in lines_of_chunks(t or "") for x in line[1:]
                         if len(x) <= MAX_TABLE_CHARS and x.split() == [x])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["chunk", "n"])

    top = (sample.mapInArrow(tally, "chunk string, n long").groupBy("chunk")
           .agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "chunk").limit(size))
    return [r.chunk for r in top.collect()]


def count_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of ``docs``.
    ``path`` is a byte-level tokenizers file on every machine."""
    spark = docs.sparkSession
    enc = encoder(path)
    table = frequent_chunks(docs, text, doc_id)
    lengths = bytes(enc.spaced_len[c] for c in table)      # at most 4 ids a character
    shared = spark.sparkContext.broadcast((" ".join(table), lengths))
    key = f"table-{hash((shared.value[0], lengths))}"

    def seed() -> dict[str, int]:
        joined, lens = shared.value
        return dict(zip(joined.split(" "), lens)) if lens else {}

    def make():
        e = encoder(path, key, seed)

        def count(texts: list) -> dict:
            n = [e.count(t) for t in texts]
            return {"n_bytes": [len(t.encode()) if t else 0 for t in texts], "n_tokens": n,
                    "over_limit": [x > limit for x in n]}
        return count

    return map_texts(docs, [doc_id], text, make,
                     {"n_bytes": "long", "n_tokens": "long", "over_limit": "boolean"}, keeps_state=True)
