"""A corpus pipeline over ``documents``: clean, drop near copies, drop secrets,
mix sources, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` writes each stage's rows as
Parquet into the shared checkpoint folder and reads them back for the next; a
stage's rows are deleted once the next one's are written, but for the last
ones, which the result reads.

Defined cases: null, empty and blank texts have too few words and go in the
first stage, so only texts with words reach the others; null ids and sources
are kept as they are; repeated rows are near copies, one of them stays; extra
columns pass through; an empty table gives no pieces.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from prodsearch.llm import mixing, ngram_join, packing, quality, secret_scan
from prodsearch.session import ensure_checkpoint_dir
from prodsearch.sources import files


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality rules keep, without their failing lines."""
    return quality.clean(docs)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word n-grams, a
    similarity of 0.8 or more."""
    return ngram_join.without_near_copies(docs, n=5, threshold=80)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return secret_scan.without_secrets(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_copy_stage),
    ("secret scans", secret_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

# The test battery of the secret scans and the tokens of the packing can't be
# said in SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{out}/{k}")
        docs = spark.read.parquet(f"{out}/{k}")
        if k:
            files.delete(spark, f"{out}/{k - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
