"""Named tables under a root folder, resolved once per application.

Resolving a Parquet table (listing files, reading footers for the schema)
costs a driver round trip; jobs that read the same table several times, or
many jobs in one application, share one resolved DataFrame instead. The
DataFrame is a lazy plan, so nothing is cached in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_RESOLVED: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``<root>/<name>.parquet`` as a DataFrame, resolved once."""
    key = (spark.sparkContext.applicationId, root.rstrip("/"), name)
    df = _RESOLVED.get(key)
    if df is None:
        df = spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
        _RESOLVED[key] = df
    return df
