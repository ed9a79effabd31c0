"""Incremental collection: a file stream of landed pages.

Each collector run lands one snapshot folder
``<root>/snapshot_ts=<yyyyMMdd_HHmmss>/api=<a>/region_code=<c>/pageNo=<n>/*.json``
page by page. A micro-batch may hold any part of a snapshot: its pages are
saved under ``pages/epoch=<id>``, and each snapshot it touches is judged and
merged anew from all of its saved pages, replacing what was written for that
snapshot before. A replayed epoch rewrites the same files (exactly-once with
the checkpoint), and a group whose last page comes in a later micro-batch is
complete then. Readers take the newest snapshot per division with
``files.latest_per_group``. The data has no event time, so there is no
watermark; the saved pages are the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import collect
from ..session import cut_lineage, ensure_checkpoint_dir
from ..sources import files
from ..sources import pages as P


# Written records, partition columns last.
RECORDS = """api string, region_code string, rec map<string,string>,
    rec_order struct<region_code:string,bpage:bigint,bpos:int,opage:bigint,opos:int>,
    region_name string, snapshot_ts string, prdt_div string"""


def stream_schema() -> T.StructType:
    return T.StructType(list(P.landing_schema().fields)
                        + [T.StructField("snapshot_ts", T.StringType())])


def read_stream(spark: SparkSession, root: str, max_files: int = 1000) -> DataFrame:
    return (spark.readStream.schema(stream_schema())
            .option("multiLine", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .option("maxFilesPerTrigger", max_files)
            .json(root).withColumn("file", F.col("_metadata.file_path")))


def process_batch(batch: DataFrame, epoch_id: int, out: str) -> None:
    """Save the micro-batch's pages under this epoch, then collect every
    snapshot it touches again, from all of its saved pages. Both writes
    replace what an earlier try of the epoch wrote."""
    spark = batch.sparkSession
    (batch.write.mode("overwrite").partitionBy("snapshot_ts")
     .parquet(f"{out}/pages/epoch={epoch_id}"))
    saved = (spark.read.schema(T.StructType(list(batch.schema.fields) + [T.StructField("epoch", T.LongType())]))
             .parquet(f"{out}/pages").where(F.col("epoch") <= epoch_id))
    touched = saved.where(F.col("epoch") == epoch_id).select("snapshot_ts").distinct()
    pages = cut_lineage(saved.join(touched, "snapshot_ts", "left_semi").drop("epoch"))
    recs = collect.merge_records(pages, group_extra=["snapshot_ts"])
    recs = cut_lineage(recs.withColumn("region_name", collect.region_name(F.col("region_code"))))
    counts = collect.record_counts(recs, pages, ["snapshot_ts"])
    bad = pages.where(P.envelope_error()).select("snapshot_ts", *P.GROUP, "pageNo", "_corrupt_record")
    for name, df, by in (("records", recs, ["snapshot_ts", "prdt_div"]),
                         ("counts", counts, ["snapshot_ts"]), ("quarantine", bad, ["snapshot_ts"])):
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*by).parquet(f"{out}/{name}"))


def start(spark: SparkSession, root: str, out: str, checkpoint: str | None = None,
          available_now: bool = True, max_files: int = 1000):
    """Start the stream; ``available_now`` processes what has landed and
    stops (scheduled runs), otherwise it keeps polling. ``max_files`` sizes a
    micro-batch; the result is the same at any size. The stream's
    checkpoint defaults to a fixed folder under the cluster's shared
    ``spark.checkpoint.dir``, so a restarted run resumes where it stopped."""
    if checkpoint is None:
        checkpoint = f"{ensure_checkpoint_dir(spark).rstrip('/')}/landing-stream"
    w = (read_stream(spark, root, max_files).writeStream
         .foreachBatch(lambda df, eid: process_batch(df, eid, out))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def newest_records(spark: SparkSession, out: str) -> DataFrame:
    """The newest snapshot of every division; no rows before any is complete."""
    r = spark.read.schema(RECORDS).parquet(f"{out}/records")
    return files.latest_per_group(r, ["prdt_div"], "snapshot_ts")
