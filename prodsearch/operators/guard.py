"""Size checks that gate every broadcast.

Nothing is broadcast on faith: a side is broadcast only after a bounded
pass proves its row count and byte size small; otherwise the caller takes
its other plan (a shuffle join, or a blocked loop over bounded pieces).
Plain equi-joins are left to AQE, which broadcasts from measured runtime
sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default byte budget for anything we ship to every executor ourselves.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def size_at_most(df: DataFrame, max_rows: int, max_bytes: int) -> tuple[int, int] | None:
    """(rows, bytes) if the frame has <= max_rows rows taking <= max_bytes as
    JSON text (a stand-in for its in-memory size), else None. One job over
    at most max_rows + 1 rows."""
    r = (df.limit(max_rows + 1)
         .agg(F.count(F.lit(1)).alias("n"),
              F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))),
                         F.lit(0)).alias("b"))
         .first())
    n, b = int(r["n"]), int(r["b"])
    return (n, b) if n <= max_rows and b <= max_bytes else None


def broadcast_if_small(df: DataFrame, max_rows: int,
                       max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when it is proven to hold <= max_rows rows and
    <= max_bytes; otherwise the frame unchanged (Spark then plans a shuffle
    join, which AQE may still turn into a broadcast from measured sizes)."""
    return F.broadcast(df) if size_at_most(df, max_rows, max_bytes) is not None else df


def row_hash(df: DataFrame):
    """Deterministic 64-bit hash of a whole row. Spark refuses to hash maps,
    so map-bearing columns are hashed through their JSON text."""
    cols = [F.to_json(F.col(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name)
            for f in df.schema.fields]
    return F.xxhash64(*cols) if cols else F.lit(0).cast("long")


def spread(df: DataFrame) -> DataFrame:
    """The rows of a scan dealt over all cores where the scan has fewer
    partitions than the session has cores (small files, whose row groups can't
    be split): what follows may be heavy on the CPU. A scan of many splits, or
    a plan that shuffles already, stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "Exchange" in plan or "AdaptiveSparkPlan" in plan or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)
