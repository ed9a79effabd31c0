"""Landed API pages: read, check envelopes, check completeness, explode
(S1-S3).

A landing is one JSON file per fetched page under
``<root>/api=<name>/region_code=<code>/pageNo=<n>/*.json``; the directory
names become columns through partition discovery (declared as strings, so
sector codes such as ``020000`` keep their zeros).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S

GROUP = ["api", "region_code"]


def landing_schema() -> T.StructType:
    return T.StructType(list(S.PAGE_SCHEMA.fields) + [
        T.StructField("_corrupt_record", T.StringType()),
        T.StructField("api", T.StringType()),
        T.StructField("region_code", T.StringType()),
        T.StructField("pageNo", T.LongType()),
    ])


def read_pages(spark: SparkSession, root: str) -> DataFrame:
    """One row per landed page, malformed files kept in ``_corrupt_record``;
    ``file`` is the page's path."""
    return (spark.read.schema(landing_schema())
            .option("multiLine", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .json(root).withColumn("file", F.col("_metadata.file_path")))


def parse_pages(df: DataFrame, json_col: str) -> DataFrame:
    """Parse page JSON held in a string column (e.g. from a message queue)."""
    schema = T.StructType(list(S.PAGE_SCHEMA.fields)
                          + [T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json(F.col(json_col), schema,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return df.withColumn("__p", parsed).select("*", "__p.*").drop("__p")


def envelope_error(result: Column | str = "result",
                   corrupt: Column | str = "_corrupt_record") -> Column:
    """A page is an error when it is not JSON or has no ``result`` object."""
    r = F.col(result) if isinstance(result, str) else result
    c = F.col(corrupt) if isinstance(corrupt, str) else corrupt
    return c.isNotNull() | r.isNull()


def quarantine(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good pages, bad pages)."""
    bad = envelope_error()
    return pages.where(~bad), pages.where(bad)


def division(pages: DataFrame) -> Column:
    """The envelope's division; a page without one belongs to its API's."""
    own = F.col("result.prdt_div")
    return F.coalesce(own, F.col("api")) if "api" in pages.columns else own


def one_per_page(pages: DataFrame, group: Sequence[str] = GROUP, page: str = "pageNo") -> DataFrame:
    """One good landed file per (group, page): a page that was landed twice
    counts once, the file with the greatest path winning. Pages from elsewhere
    (no ``file`` column) are taken as they are."""
    good = pages.where(~envelope_error())
    if "file" not in pages.columns:
        return good
    last = good.groupBy(*group, page).agg(F.max("file").alias("file"))
    return good.join(last.select("file"), "file", "left_semi")


def complete_groups(pages: DataFrame, group: Sequence[str] = GROUP,
                    page: str = "pageNo") -> DataFrame:
    """Groups whose every page 1..max_page_no arrived intact and whose
    total is non-zero. A group with a failed page is dropped whole, as the
    collector discards an (api, sector) pair on any failure; a failed page
    that was landed again intact is no failure. An envelope without
    max_page_no has one page, one without prdt_div the API's division."""
    ok = ~envelope_error()
    each = pages.groupBy(*group, F.col(page).alias("__page")).agg(
        F.max(F.when(ok, F.coalesce("result.max_page_no", F.lit(1)))).alias("max_page_no"),
        F.max("result.total_count").alias("total_count"),
        F.max(F.when(ok, division(pages))).alias("prdt_div"),
        F.max(ok).alias("__ok"), F.max(envelope_error()).alias("__bad"))
    g = each.groupBy(*group).agg(
        *[F.max(c).alias(c) for c in ("max_page_no", "total_count", "prdt_div")],
        F.count(F.when(F.col("__ok"), F.col("__page"))).alias("pages_ok"),
        F.count(F.when(F.col("__bad"), F.col("__page"))).alias("pages_bad"))
    return g.where((F.col("pages_ok") == F.col("max_page_no")) & (F.col("total_count") > 0))


def explode_records(pages: DataFrame, side: str, group: Sequence[str] = GROUP,
                    page: str = "pageNo") -> DataFrame:
    """Records of one list (``baseList`` or ``optionList``) as rows
    ``(group..., prdt_div, pageNo, pos, rec)``; (pageNo, pos) keeps page order."""
    return pages.select(*group, division(pages).alias("prdt_div"), page,
                        F.posexplode(F.col(f"result.{side}")).alias("pos", "rec"))


def records_to_columns(records: DataFrame, columns: Sequence[str],
                       types: dict[str, str] | None = None, rec: str = "rec") -> DataFrame:
    """Map entries to columns (strings unless a type is given, via try_cast)."""
    types = types or {}
    out = []
    for c in columns:
        v = F.col(rec)[c]
        out.append((v.try_cast(types[c]) if c in types else v).alias(c))
    keep = [c for c in records.columns if c != rec]
    return records.select(*keep, *out)


def pack_pages(base: DataFrame, options: DataFrame, key: str, *, division: str,
               page_size: int = 50, total: Column | None = None) -> DataFrame:
    """Build page envelopes (JSON text) from base and option rows.

    Used to land test pages and to replay tables as API pages. Options are
    cut into pages of about ``page_size`` per key: the page count of a key
    comes from its row count (a hash aggregate), and rows are spread over
    pages by hash, so no key's rows are ever collected into one list. Raw
    rows cross one shuffle on (key, page), which the page aggregate reuses;
    records are serialised after it, and a page only joins strings.
    """
    def as_json(df):
        return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in df.columns]))

    # the per-key count reads only the key (partial counts combine map-side);
    # raw rows then cross one shuffle on (key, page), which is also the
    # grouping below, so records are serialised after it on every core
    n = options.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    o = (options.join(n, key)
         .withColumn("__pages", F.greatest(F.lit(1), F.ceil(F.col("__n") / page_size)))
         .withColumn("pageNo", (F.pmod(F.xxhash64(*options.columns), F.col("__pages")) + 1))
         .repartition(key, "pageNo")
         .withColumn("__rec", as_json(options.select(*options.columns))))
    pages = o.groupBy(key, "pageNo").agg(
        F.concat_ws(",", F.collect_list("__rec")).alias("__opts"),
        F.max("__pages").alias("max_page_no"))
    b = base.select(key, as_json(base).alias("__base"))
    env = pages.join(b, key, "left")
    head = F.to_json(F.struct(
        (total if total is not None else F.lit(1)).cast("long").alias("total_count"),
        F.col("max_page_no").cast("long").alias("max_page_no"),
        F.col("pageNo").cast("long").alias("now_page_no"),
        F.lit(division).alias("prdt_div")))
    # '{"total_count":..,"prdt_div":".."}' + ',"baseList":[..],"optionList":[..]}'
    body = F.concat(F.expr("substring(__head, 1, length(__head) - 1)"),
                    F.lit(',"baseList":['), F.coalesce(F.col("__base"), F.lit("")),
                    F.lit('],"optionList":['), F.col("__opts"), F.lit("]}"))
    return (env.withColumn("__head", head)
            .select(key, "pageNo", F.concat(F.lit('{"result":'), body, F.lit("}"))
                    .alias("page_json")))
