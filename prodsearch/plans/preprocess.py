"""Preprocess job (X2): per product type project, drop, strip, coerce,
dedup, flag, render search text; plus statistics and a step audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import text as TX
from ..operators import clean, stats
from ..sources import files

POSITION = "_pos"


def with_position(df: DataFrame, name: str = POSITION) -> DataFrame:
    """Input order as a column, so keep-first dedup does not depend on
    physical row order later.

    The row id follows partition order, and Spark packs file splits
    largest first, so across several files (e.g. the part files of a
    Spark-written folder) it does not follow file order. For file sources
    the position is therefore (file path, row id): splits of one file keep
    their offset order (the packing sort is stable and only a file's last
    split is shorter), so the row id still follows rows within a file.
    """
    from pyspark.errors import AnalysisException
    try:
        df.select("_metadata.file_path")
    except AnalysisException:
        return df.withColumn(name, F.monotonically_increasing_id())
    return df.withColumn(name, F.struct(F.col("_metadata.file_path").alias("file"),
                                        F.monotonically_increasing_id().alias("row")))


def preprocess(df: DataFrame, *, core: Sequence[str], essentials: Sequence[str],
               strip_cols: Sequence[str], numeric_cols: Sequence[str],
               dedup_keys: Sequence[str], order: str, spec: Sequence[tuple] | None,
               blank_col: str | None = None, null_text: str | None = None,
               search_out: str = "search_text") -> DataFrame:
    """The cleaning chain, in the order that matters: drop rows missing an
    essential, strip, coerce numbers, then keep the first row per key."""
    p = clean.core_projection(df, list(core) + ([order] if order not in core else []))
    p = clean.drop_missing(p, essentials)
    p = clean.strip_columns(p, strip_cols)
    p = clean.coerce_numeric(p, numeric_cols)
    p = clean.keep_first(p, dedup_keys, [order])
    if blank_col and blank_col in p.columns:
        p = clean.blank_flags(p, blank_col, f"{blank_col}_available", f"{blank_col}_clean")
    if spec is None:
        text = TX.search_text_other(S.PRODUCT_COL, S.COMPANY_COL)
    else:
        types = {f.name: f.dataType.simpleString() for f in p.schema.fields}
        text = TX.search_text(types, spec, null_text=null_text)
    return p.withColumn(search_out, text)


def from_records(records: DataFrame, product_type: str, rec: str = "rec") -> DataFrame:
    """Collected records of one product type as its all-string columns (the
    division letter selects the type), with the collection order as the
    position column that keep-first dedup follows."""
    letter = {v: k for k, v in S.DIVISION_TYPES.items()}[product_type]
    cols = [f.name for f in S.product_schema(product_type).fields]
    r = records.where(F.col("prdt_div") == letter)
    out = [F.col(rec)[c].alias(c) for c in cols if c not in ("region_code", "region_name")]
    keep = [c for c in ("region_code", "region_name", "snapshot_ts") if c in records.columns]
    if "rec_order" in records.columns:
        keep.append(F.col("rec_order").alias(POSITION))
    return r.select(*keep, *out)


def preprocess_product(df: DataFrame, product_type: str, compat: bool = False) -> DataFrame:
    """Bind the chain to one product type's columns and template."""
    if product_type not in S.CORE_COLUMNS:
        raise ValueError(f"unsupported product type {product_type!r}")
    if POSITION not in df.columns:
        df = with_position(df)
    return preprocess(
        df, core=S.CORE_COLUMNS[product_type], essentials=S.ESSENTIAL_COLUMNS,
        strip_cols=S.ESSENTIAL_COLUMNS, numeric_cols=S.numeric_columns(product_type, compat),
        dedup_keys=S.ESSENTIAL_COLUMNS, order=POSITION,
        spec=S.SEARCH_TEXT_SPECS.get(product_type),
        blank_col="etc" if product_type == "annuity" else None,
        null_text="nan" if compat else None)


# Rate columns summarised per type: (column, with mean).
RATE_SUMMARY = {
    "deposit": [("intr_rate", True), ("intr_rate2", True)],
    "saving": [("intr_rate", True), ("intr_rate2", True)],
    "annuity": [("dcls_rate", True), ("guar_rate", True), ("btrm_prft_rate_1", False),
                ("btrm_prft_rate_2", False), ("btrm_prft_rate_3", False)],
    "mortgage": [("lend_rate_min", False), ("lend_rate_max", False)],
    "rent": [("lend_rate_min", False), ("lend_rate_max", False)],
    "credit": [("crdt_grad_avg", False)],
}
DISTRIBUTIONS = {"saving": "rsrv_type_nm", "annuity": "pnsn_kind_nm"}


def product_statistics(products: DataFrame, product_type: str, run_time: str) -> dict[str, DataFrame]:
    """Statistics tables of one processed type. ``run_time`` is a job
    parameter (never the clock inside compared output)."""
    t = products.withColumn("product_type", F.lit(product_type))
    out = {
        "counts": stats.product_company_counts(t, ["product_type"], S.COMPANY_COL)
        .withColumn("run_time", F.lit(run_time)),
        "top_companies": stats.top_values(t, ["product_type"], S.COMPANY_COL, 5),
    }
    cols = [c for c, _ in RATE_SUMMARY[product_type] if c in t.columns]
    if cols:
        r = stats.range_stats(t, ["product_type"], cols, mean_digits=None)
        with_mean = [c for c, m in RATE_SUMMARY[product_type] if m]
        out["rates"] = r.select(
            "product_type", "metric", TX.pct_range("lo", "hi").alias("range"),
            F.when(F.col("metric").isin(with_mean), TX.pct("mean")).alias("mean"))
    dist = DISTRIBUTIONS.get(product_type)
    if dist and dist in t.columns:
        out["distribution"] = stats.value_distribution(t, ["product_type"], dist)
    return out


def newest_raw_files(spark: SparkSession, root: str) -> dict[str, str]:
    """Per product type the raw CSV (a file, or a folder of part files) with
    the latest snapshot time in its name. One listing, no content is read; a
    row for each type comes to the driver."""
    name = r"^(.*/([A-Z])_(\d{8}_\d{6})\.csv)(?:/[^/]+)?$"
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
              .option("pathGlobFilter", "*.csv").load(root)
              .select(*[F.regexp_extract("path", name, k).alias(c) for k, c in ((1, "path"), (2, "div"), (3, "ts"))])
              .where(F.col("div").isin(list(S.DIVISION_TYPES))))
    newest = listed.groupBy("div").agg(F.max_by("path", "ts").alias("path"))
    return {S.DIVISION_TYPES[r.div]: r.path for r in newest.collect()}


def preprocess_all(spark: SparkSession, raw_root: str, out: str, run_time: str,
                   compat: bool = False) -> DataFrame:
    """The whole job over the six types, side by side: each type's newest raw
    file is read, cleaned and written with its statistics and its step audit. A
    type without a file is skipped, one that fails stops no other. Returns the
    status table ``(product_type, status, rows, error)``."""
    newest = newest_raw_files(spark, raw_root)

    def job(product_type: str) -> DataFrame | None:
        path = newest.get(product_type)
        if path is None:
            return None
        raw = with_position(files.read_raw_csv(spark, path))
        done = preprocess_product(raw, product_type, compat).drop(POSITION)
        files.write_processed(done.withColumn("product_type", F.lit(product_type)), f"{out}/processed")
        saved = spark.read.parquet(f"{out}/processed/product_type={product_type}")
        tables = dict(product_statistics(saved, product_type, run_time))
        stripped = clean.strip_columns(raw, S.ESSENTIAL_COLUMNS)
        whole = F.lit(True)
        for c in S.ESSENTIAL_COLUMNS:
            whole = whole & F.col(c).isNotNull()
        tables["audit"] = stats.step_audit(stripped, whole, S.ESSENTIAL_COLUMNS)
        for name, df in tables.items():
            (df.withColumn("product_type", F.lit(product_type)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("product_type")
             .parquet(f"{out}/{name}"))
        return saved

    return files.run_per_type(spark, list(S.CORE_COLUMNS), job)
