"""Collect job (X1): landed pages -> joined, tagged product records and
per-division counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import clean, joins, stats
from ..session import cut_lineage
from ..sources import files, pages as P


def region_name(code: Column) -> Column:
    """Sector name of a code from the fixed code list (literal map, no join)."""
    m = F.create_map(*[x for kv in S.REGION_CODES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return m[code]


def _suffix_keys(rec: Column, names: Column, suffix: str) -> Column:
    """Rename the map keys listed in ``names``."""
    return F.transform_keys(rec, lambda k, _v: F.when(
        F.array_contains(names, k), F.concat(k, F.lit(suffix))).otherwise(k))


def _names(records: Column) -> Column:
    """The distinct keys of a page's records."""
    keys = F.transform(F.coalesce(records, F.array().cast("array<map<string,string>>")),
                       lambda r: F.coalesce(F.map_keys(r), F.array().cast("array<string>")))
    return F.array_distinct(F.flatten(keys))


def _n(records: Column) -> Column:
    return F.coalesce(F.size(records), F.lit(0))


def merge_records(pages_df: DataFrame, null_safe: bool = False,
                  group_extra: tuple[str, ...] | list[str] = (),
                  hot_rows: int | None = joins.DEFAULT_HOT_ROWS) -> DataFrame:
    """Base and option records of every complete (api, sector) group, joined
    base-left-option on the product code (company code for division F);
    groups without base records keep their options as they are, the code
    included. Columns that both sides of a group have get ``_x`` and ``_y``,
    whether a row has a match or not. Output: ``(api, region_code,
    [group_extra], prdt_div, rec map<string,string>, rec_order)``;
    ``rec_order`` sorts records in collection order."""
    group = [*group_extra, *P.GROUP]
    by = [*group, "prdt_div"]
    good = P.complete_groups(pages_df, group).select(*group)
    pages = P.one_per_page(pages_df, group).withColumn("prdt_div", P.division(pages_df))
    div_key = F.when(F.col("prdt_div") == S.COMPANY_DIVISION, F.lit(S.COMPANY_KEY)).otherwise(
        F.lit(S.PRODUCT_KEY))
    # what the rows of a group need to know of each other, from its pages: the
    # columns that both sides have and whether there are base records
    sides = {x: F.col(f"result.{x}List") for x in ("base", "option")}
    about = (pages.groupBy(*by).agg(
                F.array_intersect(*[F.flatten(F.collect_set(_names(c))) for c in sides.values()]).alias("both"),
                F.max(F.greatest(_n(sides["base"]), F.lit(0)) > 0).alias("has_base"))
             .withColumn("both", F.filter("both", lambda x: x != div_key)).join(good, group, "left_semi"))
    options = pages.groupBy(*by).agg(F.sum(F.greatest(_n(sides["option"]), F.lit(0))).alias("n"))
    if hot_rows is not None and (options.agg(F.max("n")).first()[0] or 0) <= hot_rows:
        hot_rows = None                 # no key has more rows than its group
    ok_pages = pages.join(about, by)
    base = (P.explode_records(ok_pages, "baseList", [*group, "both"])
            .withColumn("k", F.col("rec")[div_key])
            .withColumn("rec", _suffix_keys(F.col("rec"), F.col("both"), "_x"))
            .withColumnsRenamed({"rec": "brec", "pageNo": "bpage", "pos": "bpos"}))
    opt = (P.explode_records(ok_pages, "optionList", [*group, "has_base"])
           .withColumn("k", F.col("rec")[div_key])
           .withColumnsRenamed({"rec": "orec", "pageNo": "opage", "pos": "opos"}))
    merged = joins.option_only_fallback(base, opt, keys=["k"], groups=by,
                                        null_safe=null_safe, hot_rows=hot_rows,
                                        salt_cols=["opage", "opos"], has_base="has_base")
    empty = F.create_map().cast(S.RECORD)
    names = F.coalesce("both", F.array().cast("array<string>"))
    o = F.when(F.col("brec").isNull(), F.col("orec")).otherwise(
        F.map_filter(F.coalesce(F.col("orec"), empty), lambda k, _v: k != div_key))
    rec = F.when(F.col("brec").isNull(), o).otherwise(
        F.map_concat("brec", _suffix_keys(o, names, "_y")))
    # the order records were accumulated in: sectors in code order, base rows
    # in page order, each followed by its options in page order
    order = F.struct("region_code", "bpage", "bpos", "opage", "opos")
    return merged.select(*group, F.col("prdt_div"), rec.alias("rec"), order.alias("rec_order"))


def record_counts(recs: DataFrame, pages_df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Records per division with the totals their groups reported."""
    group = [*extra, *P.GROUP]
    totals = P.complete_groups(pages_df, group).select(*group, "total_count")
    per = recs.groupBy(*group, "prdt_div").agg(F.count(F.lit(1)).alias("n"))
    return stats.division_counts(per.join(totals, group), [*extra, "prdt_div"], group,
                                 F.col("total_count"), rows=F.col("n"))


def collect_landing(spark: SparkSession, root: str, snapshot_ts: str,
                    null_safe: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, counts, quarantined pages) of one landing. The pages are
    parsed once, into the shared checkpoint folder."""
    pages_df = cut_lineage(P.read_pages(spark, root))
    _, bad = P.quarantine(pages_df)
    recs = merge_records(pages_df, null_safe)
    recs = clean.tag_constants(recs, {"snapshot_ts": snapshot_ts}).withColumn(
        "region_name", region_name(F.col("region_code")))
    counts = clean.tag_constants(record_counts(recs, pages_df), {"snapshot_ts": snapshot_ts})
    return recs, counts, bad.select(*P.GROUP, "pageNo", "_corrupt_record")


def reported_totals(pages_df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """(prdt_div, reported): the totals that the groups with records reported,
    from the pages alone (a group has records if one of its lists has any)."""
    group = [*extra, *P.GROUP]
    totals = P.complete_groups(pages_df, group).select(*group, "total_count")
    filled = F.coalesce(F.size("result.baseList"), F.lit(0)) + F.coalesce(F.size("result.optionList"), F.lit(0)) > 0
    held = (P.one_per_page(pages_df, group).where(filled)
            .select(*group, P.division(pages_df).alias("prdt_div")).distinct())
    return held.join(totals, group).groupBy(*extra, "prdt_div").agg(
        F.sum("total_count").cast("long").alias("reported"))


def collect_job(spark: SparkSession, root: str, out: str, snapshot_ts: str) -> DataFrame:
    """Collect, then write records and counts; returns the counts. The record
    counts are observed while the records are written, so these are computed
    once. A repeated run of a snapshot replaces it."""
    pages_df = cut_lineage(P.read_pages(spark, root))
    recs = clean.tag_constants(merge_records(pages_df), {"snapshot_ts": snapshot_ts}).withColumn(
        "region_name", region_name(F.col("region_code")))
    written = files.write_raw(recs, f"{out}/records") or {}
    records = spark.createDataFrame(list(written.items()), "prdt_div string, records long")
    counts = records.join(reported_totals(pages_df), "prdt_div").select("prdt_div", "records", "reported")
    files.write_counts(clean.tag_constants(counts, {"snapshot_ts": snapshot_ts}), f"{out}/counts")
    return spark.read.parquet(f"{out}/counts")


def collect_tables(base: DataFrame, options: DataFrame, key: str, division: str,
                   region_code: str = "020000",
                   hot_rows: int | None = joins.DEFAULT_HOT_ROWS,
                   row_id: list[str] | None = None) -> DataFrame:
    """The same job over already-tabular base and option records: J1 left
    join (hot keys salted), sector tag, per-division records and reported
    totals (distinct base keys). ``row_id``: option columns that tell the
    rows of one key apart, hashed for the salt (whole row if None)."""
    j = joins.left_join_records(base, options, [key], hot_rows=hot_rows, salt_cols=row_id)
    j = clean.tag_constants(j, {"region_code": region_code})
    return (j.groupBy(F.col(division).alias("prdt_div"), "region_code")
            .agg(F.count(F.lit(1)).alias("records"),
                 F.count_distinct(key).alias("reported")))
