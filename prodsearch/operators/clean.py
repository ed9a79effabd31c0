"""Projection, null handling, tagging and keep-first dedup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as TX


def core_projection(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Select the listed columns that exist, in list order; absent ones are
    skipped silently. Column pruning reaches the scan."""
    present = set(df.columns)
    return df.select(*[c for c in columns if c in present])


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows where any essential column is null (blank strings stay)."""
    return df.na.drop(how="any", subset=list(subset))


def strip_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Unicode strip of the given string columns (only those present)."""
    present = set(df.columns)
    return df.withColumns({c: TX.strip(c) for c in columns if c in present})


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text to double for the given columns; bad values become null."""
    present = set(df.columns)
    return df.withColumns({c: TX.to_number(c) for c in columns if c in present})


def null_tokens(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV missing-value tokens (``N/A``, ``NULL``, ``nan``, ...) to null."""
    cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    if columns is not None:
        cols = [c for c in cols if c in set(columns)]
    return df.withColumns({c: TX.null_if_token(c) for c in cols})


def blank_flags(df: DataFrame, column: str, available: str | None = None,
                clean: str | None = None) -> DataFrame:
    """Add ``<col>_available`` (non-null, non-blank) and ``<col>_clean``
    (null to blank, stripped)."""
    available = available or f"{column}_available"
    clean = clean or f"{column}_clean"
    return df.withColumns({available: TX.is_available(column), clean: TX.blank_clean(column)})


def tag_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add constant columns (e.g. the sector code and name of a landing)."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace null in each column by its default."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def required_fields(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows whose every listed field is non-null and non-blank."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & TX.is_filled(c)
    return df.where(cond)


def pack_raw(df: DataFrame, columns: Sequence[str] | None = None, name: str = "raw_data") -> DataFrame:
    """Pack the row (or the listed columns) into ``map<string,string>``.

    Product types have different columns, so a map (not a struct) lets the
    packed rows of all types union into one column.
    """
    cols = list(columns) if columns is not None else list(df.columns)
    pairs = []
    for c in cols:
        pairs += [F.lit(c), F.col(c).cast("string")]
    return df.withColumn(name, F.create_map(*pairs))


def normalize_roles(df: DataFrame, role: str = "role") -> DataFrame:
    """``user`` stays ``user``; every other role becomes ``assistant``."""
    return df.withColumn(role, F.when(F.col(role) == "user", F.lit("user"))
                         .otherwise(F.lit("assistant")))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row of every key group by an explicit order.

    ``dropDuplicates`` keeps an arbitrary row, so the order is a column (the
    input position). ``row_number() <= 1`` over the key lets Spark plan a
    partial WindowGroupLimit before the shuffle: each map task already keeps
    only its first row per key, so a hot key ships one row per task, not all
    of its rows.
    """
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*[F.col(o).asc_nulls_last() for o in order])
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= 1).drop("_rn"))
