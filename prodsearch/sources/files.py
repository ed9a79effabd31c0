"""Raw CSV in, Parquet/CSV out, processed tables back in, snapshot choice
(S4-S10)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..operators import clean, guard

# a raw file, or a folder of part files, of one division and snapshot
SNAPSHOT_RE = r"([A-Z])_(\d{8}_\d{6})\.csv(?:/[^/]+)?$"


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 apply_null_tokens: bool = True) -> DataFrame:
    """Read raw product CSV: header, all strings, quoted multi-line cells,
    BOM tolerated; pandas' missing-value tokens become null.

    The header decides the columns, and every one is read as a string (no
    inference: sector codes like ``020000`` must stay text). All files of the
    path must have the header of the first one: a file with another (say, of
    another division, or in another order) ends the read with an error
    instead of shifting its columns. ``schema`` picks its columns by name,
    casts them, and gives null for those the files lack.
    """
    reader = (spark.read.option("header", True).option("multiLine", True)
              .option("escape", '"').option("quote", '"').option("encoding", "UTF-8")
              .option("inferSchema", False).option("mode", "PERMISSIVE"))
    header = reader.csv(path).columns
    strings = T.StructType([T.StructField(c, T.StringType()) for c in header])
    df = reader.schema(strings).option("enforceSchema", False).csv(path)
    # a BOM, when present, sticks to the first header name
    df = df.withColumnsRenamed({c: c.lstrip("\ufeff") for c in df.columns if c.startswith("\ufeff")})
    if schema is not None:
        df = df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast("string"))
                         .try_cast(f.dataType).alias(f.name) for f in schema.fields])
    return clean.null_tokens(df) if apply_null_tokens else df


def land_csv(df: DataFrame, path: str) -> None:
    """Write a table as raw CSV the way the collector's files are: all cells
    quoted where needed, line breaks inside cells, a header, and a byte order
    mark before it; nulls and empty texts are empty cells, which are read back
    as null. ``path`` becomes a folder of part files, each with the header."""
    first = df.columns[0]
    cells = [F.col(f"`{c}`").cast("string").alias("\ufeff" + c if c == first else c) for c in df.columns]
    (df.select(*cells).write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def with_snapshot(df: DataFrame) -> DataFrame:
    """Division letter and snapshot time from the name of the source file, or
    of its folder of part files (``D_20250714_175227.csv``)."""
    name = F.col("_metadata.file_path")
    return df.withColumns({
        "prdt_div": F.regexp_extract(name, SNAPSHOT_RE, 1),
        "snapshot_ts": F.regexp_extract(name, SNAPSHOT_RE, 2),
    })


def latest_per_group(df: DataFrame, group: Sequence[str], order: str | F.Column) -> DataFrame:
    """Rows whose order value equals their group's maximum (rank() == 1).

    A hash aggregate of the maxima joined back on (group, value), instead of a
    window that would sort every group in one task.
    """
    o = F.col(order) if isinstance(order, str) else order
    t = df.withColumn("__o", o)
    mx = t.groupBy(*group).agg(F.max("__o").alias("__o"))
    return t.join(mx, [*group, "__o"], "left_semi").drop("__o")


def flatten_records(df: DataFrame, rec: str = "rec") -> DataFrame:
    """Map records to one string column per key (the union of keys, sorted),
    for formats without map columns. The key set is a distributed distinct;
    only the keys, which are the columns of the output, reach the driver."""
    keys_df = df.select(F.explode(F.map_keys(rec)).alias("k")).distinct()
    keys = sorted(r["k"] for r in keys_df.collect())
    others = [c for c in df.columns if c != rec and c not in keys]
    return df.select(*others, *[F.col(rec)[k].alias(k) for k in keys])


def _folder(spark: SparkSession, path: str):
    """(file system, path) of a folder, in whatever store it is."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder and all in it."""
    fs, folder = _folder(spark, path)
    fs.delete(folder, True)


def write_raw(df: DataFrame, out: str, fmt: str = "parquet",
              divisions: Sequence[str] = tuple(S.DIVISION_TYPES) + (S.COMPANY_DIVISION,)) -> dict[str, int] | bool:
    """Write collected records partitioned by division and snapshot; the
    records written per division, or False for none.

    Idempotent: a run stages its files and, when the job is done, replaces the
    (division, snapshot) folders that it wrote, so a repeated run of a snapshot
    leaves what one run leaves, and a failed one nothing. The counts are
    observed on the running write (no second scan, no probe for an empty
    frame); only if a division is none of ``divisions`` they are read back from
    the files' footers. Parquet keeps the record map; CSV gets one column per
    record key. An empty frame leaves no folder behind.
    """
    spark = df.sparkSession
    fs, folder = _folder(spark, out)
    existed = fs.exists(folder)
    div = F.col("prdt_div").cast("string")
    seen = Observation()
    w = df
    if fmt == "csv":
        w = flatten_records(df) if "rec" in df.columns else df
        # CSV has no nested types: structs and arrays go out as JSON text
        w = w.withColumns({f.name: F.to_json(f.name) for f in w.schema.fields
                           if f.dataType.typeName() in ("struct", "array", "map")})
    w = w.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set("snapshot_ts").alias("snapshots"),
                  *[F.count_if(div == d).alias(d) for d in divisions])
    writer = (w.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("prdt_div", "snapshot_ts"))
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(out)
    else:
        writer.parquet(out)
    got = seen.get
    if not got["rows"]:
        if not existed:
            fs.delete(folder, True)
        return False
    found = {d: got[d] for d in divisions if got[d]}
    if sum(found.values()) < got["rows"]:
        saved = spark.read.parquet(out) if fmt != "csv" else spark.read.option("header", True).csv(out)
        found = {str(r.prdt_div): r["count"] for r in saved.where(F.col("snapshot_ts").isin(list(got["snapshots"])))
                 .groupBy("prdt_div").count().collect()}
    return found


def write_counts(counts: DataFrame, out: str) -> None:
    """Reported totals next to the data (one small table). It is written after
    the records and replaces the snapshot's earlier counts, which makes it the
    list of what is committed: see ``committed`` and ``latest_snapshots``."""
    (counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("snapshot_ts").parquet(out))


MAX_SNAPSHOTS = 100_000     # (division, snapshot) folders whose list may be broadcast


def _partitions(spark: SparkSession, records: str, wanted: DataFrame) -> DataFrame:
    """The records of the wanted (prdt_div, snapshot_ts). Both are partition
    columns, so the list prunes the scan at run time: other folders are not read."""
    schema = spark.read.parquet(records).schema
    kinds = {c: "string" if c in ("prdt_div", "snapshot_ts") else schema[c].dataType for c in schema.names}
    data = spark.read.schema(T.StructType([T.StructField(c, T.StringType() if k == "string" else k)
                                           for c, k in kinds.items()])).parquet(records)
    return data.join(guard.broadcast_if_small(wanted, MAX_SNAPSHOTS), ["prdt_div", "snapshot_ts"], "left_semi")


def committed(spark: SparkSession, records: str, counts: str) -> DataFrame:
    """The records of every division and snapshot whose counts were written.
    A folder that a run left without finishing, or that a rerun no longer
    filled, is not read. The list has a row for each division and snapshot."""
    wanted = _counted(spark, counts).where("records > 0").select("prdt_div", "snapshot_ts")
    return _partitions(spark, records, wanted)


def latest_snapshots(spark: SparkSession, records: str, counts: str) -> DataFrame:
    """The records of each division's newest committed snapshot. The newest
    ones come from the counts alone; the scan of the records is pruned to their folders."""
    newest = (_counted(spark, counts).where("records > 0").groupBy("prdt_div")
              .agg(F.max("snapshot_ts").alias("snapshot_ts")).where(F.col("snapshot_ts") > ""))
    return _partitions(spark, records, newest)


def _counted(spark: SparkSession, counts: str) -> DataFrame:
    return spark.read.schema("prdt_div string, records long, reported long, snapshot_ts string").parquet(counts)


def write_processed(df: DataFrame, out: str, mode: str = "overwrite") -> None:
    """Processed products, one folder per product type; a rerun replaces
    only the types it wrote."""
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy("product_type").parquet(out))


def union_typed(frames: Mapping[str, DataFrame], renames: Mapping[str, str] | None = None,
                type_col: str = "product_type") -> DataFrame:
    """One table from per-type frames: a literal type column, canonical
    names, union by name with missing columns as null."""
    out = None
    for t, df in frames.items():
        d = df.withColumnsRenamed({k: v for k, v in (renames or {}).items() if k in df.columns})
        d = d.withColumn(type_col, F.lit(t))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    if out is None:
        raise ValueError("no frames to union")
    return out


def run_per_type(spark: SparkSession, types: Sequence[str],
                 job: Callable[[str], DataFrame | None], at_once: int | None = None) -> DataFrame:
    """Run ``job`` for every type, ``at_once`` (all) of them side by side; a
    missing input or a failure of one type does not stop the others. Returns
    ``(product_type, status, rows, error)`` in the order of ``types``.

    Each type's jobs are submitted by a thread of their own, in a scheduler pool
    named after the type, so that with ``spark.scheduler.mode=FAIR`` a large
    type doesn't hold up the others; the driver's threads only wait.
    """
    sc = spark.sparkContext

    def run(t: str):
        sc.setLocalProperty("spark.scheduler.pool", t)
        try:
            df = job(t)
            return (t, "missing", None, None) if df is None else (t, "ok", int(df.count()), None)
        except Exception as e:  # noqa: BLE001 - reported, not raised
            return (t, "failed", None, str(e)[:500])
        finally:
            sc.setLocalProperty("spark.scheduler.pool", None)

    # wrapped one by one: each thread gets local properties of its own
    jobs = [inheritable_thread_target(spark)(partial(run, t)) for t in types]
    with ThreadPoolExecutor(max_workers=max(1, at_once or len(types))) as pool:
        rows = list(pool.map(lambda job: job(), jobs))
    return spark.createDataFrame(rows, "product_type string, status string, rows long, error string")
