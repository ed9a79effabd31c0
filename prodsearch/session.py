"""Spark session and cluster settings shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes (a join
# side becomes a broadcast only once its materialised size is under the
# threshold), coalesces small shuffle partitions and splits skewed ones.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # static broadcast only below 10 MB of estimated (compressed) size; AQE
    # may convert a join later from measured shuffle sizes up to 32 MB
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # post-shuffle partitions are coalesced towards this size
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    # checkpoint files go when the driver has dropped the frames that use them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_conf(input_bytes: int, cores: int) -> dict[str, str]:
    """Shuffle sizing for a cluster run: enough initial partitions that the
    largest shuffle gets ~128 MB per partition (AQE coalesces the rest), and
    never fewer than 3 per core. For 100 TB on 1000 executors x 8 cores this
    gives ~800k initial partitions; AQE merges them down."""
    initial = max(3 * cores, input_bytes // (128 * 1024 * 1024))
    return {"spark.sql.shuffle.partitions": str(initial),
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial)}


def build_session(master: str | None = None, app: str = "prodsearch",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    On a cluster, call without ``master`` so spark-submit decides; locally
    the caller passes ``local[N]`` and a matching shuffle-partition count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only when it is unset on a local
    master (tests) do we create a private scratch folder for it; on a cluster
    a folder of one machine would not do, so that is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not (sc.master.startswith("local") and not sc.master.startswith("local-cluster")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    local = tempfile.mkdtemp(prefix="prodsearch-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint folder.

    Used where a plan would otherwise recompute a long lineage after an
    executor loss; never ``localCheckpoint``, whose blocks die with the executor.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
