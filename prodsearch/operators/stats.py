"""Aggregations: collection counts, product statistics, distributions,
availability, step audit and turn counts (A1-A10)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as TX


def division_counts(df: DataFrame, division: str | Sequence[str], group: Sequence[str],
                    reported: Column, records: str = "records",
                    reported_out: str = "reported", rows: Column | None = None) -> DataFrame:
    """Per division: joined records and the sum of the totals each group
    reported. A group's reported total is taken once (max over its rows);
    only groups that produced rows count. Two hash aggregates with partial
    (map-side) combining, so hot divisions cost nothing extra. ``rows``: the
    number of records that a row stands for (one if None)."""
    by = [division] if isinstance(division, str) else list(division)
    g = (df.groupBy(*by, *[c for c in group if c not in by])
         .agg((F.count(F.lit(1)) if rows is None else F.sum(rows)).alias("__n"), F.max(reported).alias("__total")))
    return (g.where(F.col("__n") > 0).groupBy(*by)
            .agg(F.sum("__n").cast("long").alias(records),
                 F.sum("__total").cast("long").alias(reported_out)))


def collection_summary(df: DataFrame, division: str) -> DataFrame:
    """A row per division with its number of records, and one with a null
    division for the whole: the number of divisions and of records."""
    per = df.groupBy(division).agg(F.count(F.lit(1)).alias("n_records"))
    whole = per.agg(F.lit(None).cast(df.schema[division].dataType).alias(division),
                    F.count(division).alias("n_divisions"),
                    F.coalesce(F.sum("n_records"), F.lit(0)).alias("n_records"))
    return per.where(F.col(division).isNotNull()).select(
        division, F.lit(None).cast("long").alias("n_divisions"), "n_records").union(whole)


def product_company_counts(df: DataFrame, group: Sequence[str], company: str,
                           approx: bool = False) -> DataFrame:
    """Products and distinct companies (nulls not counted) per group."""
    distinct = F.approx_count_distinct(company) if approx else F.count_distinct(company)
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("n_products"),
                                  distinct.alias("n_companies"))


SKETCH_LG = 14              # 2^14 slots: a standard error of about 0.6 %


def distinct_sketches(df: DataFrame, by: Sequence[str], column: str, out: str = "sketch",
                      lg_size: int = SKETCH_LG) -> DataFrame:
    """Per group a mergeable sketch of a column's distinct values (nulls not
    counted) with the number of rows: small rows to store per snapshot, so that
    counts over any set of snapshots need no second look at the data. A hot
    group is combined map-side."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(column, lg_size).alias(out), F.count(F.lit(1)).alias("n_rows"))


def merged_distinct(sketches: DataFrame, group: Sequence[str], sketch: str = "sketch",
                    out: str = "n_distinct") -> DataFrame:
    """Distinct values and rows per group from stored sketches."""
    return sketches.groupBy(*group).agg(
        F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias(out), F.sum("n_rows").alias("n_rows"))


def top_values(df: DataFrame, group: Sequence[str], value: str, n: int = 5,
               out: str = "n") -> DataFrame:
    """The n most frequent values per group (count desc, value asc)."""
    counts = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias(out))
    w = Window.partitionBy(*group).orderBy(F.col(out).desc(), F.col(value).asc())
    return counts.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n).drop("__r")


def range_stats(df: DataFrame, group: Sequence[str], columns: Sequence[str],
                mean_digits: int | None = 6, metric: str = "metric") -> DataFrame:
    """min / max / mean of each column over its non-null values, per group,
    in long form ``(group..., metric, lo, hi, mean)``.

    All columns are aggregated in one pass, then the small result is
    unpivoted (unpivoting first would multiply the scanned rows). A column
    with no values in a group emits no row.
    """
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.min(c).alias(f"__lo{i}"), F.max(c).alias(f"__hi{i}"),
                 F.avg(c).alias(f"__m{i}"), F.count(c).alias(f"__n{i}")]
    wide = df.groupBy(*group).agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias(metric), F.col(f"__lo{i}").alias("lo"),
                 F.col(f"__hi{i}").alias("hi"), F.col(f"__m{i}").alias("mean"),
                 F.col(f"__n{i}").alias("n"))
        for i, c in enumerate(columns)]))
    long = wide.select(*group, rows.alias("__s")).select(*group, "__s.*")
    long = long.where(F.col("n") > 0).drop("n")
    if mean_digits is not None:
        long = long.withColumn("mean", F.round("mean", mean_digits))
    return long


def range_text(df: DataFrame, group: Sequence[str], column: str,
               range_out: str = "range", mean_out: str = "mean") -> DataFrame:
    """``x.xx% ~ y.yy%`` range and ``x.xx%`` mean of a column per group; a
    group without values gives no row."""
    g = df.groupBy(*group).agg(F.min(column).alias("__lo"), F.max(column).alias("__hi"),
                               F.avg(column).alias("__m"))
    return g.where(F.col("__lo").isNotNull()).select(*group, TX.pct_range("__lo", "__hi").alias(range_out),
                    TX.pct("__m").alias(mean_out))


def value_distribution(df: DataFrame, group: Sequence[str], value: str,
                       out: str = "n") -> DataFrame:
    """Counts per value (null values excluded)."""
    return (df.where(F.col(value).isNotNull()).groupBy(*group, value)
            .agg(F.count(F.lit(1)).alias(out)))


def availability_ratio(df: DataFrame, group: Sequence[str], flag: Column,
                       digits: int = 4) -> DataFrame:
    """Available rows, all rows and the percentage (null for no rows)."""
    g = df.groupBy(*group).agg(F.count_if(flag).alias("available"),
                               F.count(F.lit(1)).alias("total"))
    pct = F.try_divide(F.col("available") * F.lit(100.0), F.col("total"))
    return g.withColumn("pct", F.round(pct, digits))


def type_distribution(df: DataFrame, type_col: str, total_label: str = "ALL",
                      labels: Mapping[str, str] | None = None) -> DataFrame:
    """Count per type plus a grand total (one ROLLUP), with ``1,234``
    text; types shown by label where a label is known."""
    g = df.rollup(type_col).agg(F.count(F.lit(1)).alias("n"),
                                F.grouping(type_col).alias("__g"))
    name = F.when(F.col("__g") == 1, F.lit(total_label)).otherwise(F.col(type_col))
    if labels:
        m = F.create_map(*[x for kv in labels.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
        name = F.when(F.col("__g") == 1, F.lit(total_label)).otherwise(
            F.coalesce(m[F.col(type_col)], F.col(type_col)))
    return g.select(name.alias(type_col), "n", TX.thousands("n").alias("n_text"))


def step_audit(df: DataFrame, keep_after_drop: Column, dedup_keys: Sequence[str]) -> DataFrame:
    """Row counts before any step, after the drop step and after dedup,
    from one scan: conditional count and a distinct count over the keys of
    the surviving rows."""
    key = F.when(keep_after_drop, F.struct(*[F.col(k) for k in dedup_keys]))
    return df.agg(F.count(F.lit(1)).alias("n_in"),
                  F.count_if(keep_after_drop).alias("n_after_drop"),
                  F.count_distinct(key).alias("n_after_dedup"))


def turn_counts(messages: DataFrame, conv: str = "conv_id", out: str = "turns") -> DataFrame:
    """Messages per conversation // 2."""
    return (messages.groupBy(conv).agg(F.count(F.lit(1)).alias("__n"))
            .select(conv, F.floor(F.col("__n") / 2).cast("long").alias(out)))
