"""Joins: base/option records, option-only fallback, label lookup,
grounding and passage containment (J1-J4)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import guard


# Option rows per key above which the collect job salts a join key.
DEFAULT_HOT_ROWS = 1_000_000


def _rename_overlaps(base: DataFrame, options: DataFrame, keys: Sequence[str],
                     suffixes: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
    overlap = (set(base.columns) & set(options.columns)) - set(keys)
    b = base.withColumnsRenamed({c: c + suffixes[0] for c in overlap})
    o = options.withColumnsRenamed({c: c + suffixes[1] for c in overlap})
    return b, o


def left_join_records(base: DataFrame, options: DataFrame, keys: Sequence[str],
                      null_safe: bool = False,
                      suffixes: tuple[str, str] = ("_x", "_y"),
                      hot_rows: int | None = None,
                      salt_cols: Sequence[str] | None = None) -> DataFrame:
    """Every base row with each matching option row (or nulls).

    Non-key columns present on both sides get ``_x`` / ``_y`` suffixes and
    the keys appear once, taken from the base side. ``null_safe`` makes null
    keys match each other (the literal behaviour of a pandas merge); by
    default they do not.

    ``hot_rows``: keys with more option rows than this are salted (see
    ``_salted_left_join``). AQE can split a skewed *left* side of a left
    join but not the right, so hot option keys need this. ``salt_cols``
    (option columns that tell the rows of one key apart, e.g. page and
    position) feed the salt hash; by default the whole option row does,
    which makes every option column part of the scan.
    """
    keys = list(keys)
    b, o = _rename_overlaps(base, options, keys, suffixes)
    if hot_rows is not None:
        renamed = set(options.columns) & set(base.columns)
        salt = None if salt_cols is None else [
            c + suffixes[1] if c in renamed and c not in keys else c for c in salt_cols]
        return _salted_left_join(b, o, keys, hot_rows, salt, null_safe)
    return _on(b, o, keys, null_safe, "left")


def _on(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool, how: str) -> DataFrame:
    """Left-side join on equal keys, the keys kept from the left; ``null_safe``
    makes null keys equal."""
    ok = {k: f"__r_{k}" for k in keys}
    r = right.withColumnsRenamed(ok)
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(ok[k])) if null_safe else F.col(k) == F.col(ok[k])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*ok.values())


def _salted_left_join(b: DataFrame, o: DataFrame, keys: list[str], hot_rows: int,
                      salt_cols: list[str] | None = None, null_safe: bool = False) -> DataFrame:
    """Left join that splits hot keys, and only these. One job counts option
    rows by key (it reads the keys only); without a key of more than
    ``hot_rows`` option rows the join is the plain one. Else the two sides are
    parted: cold keys are joined plainly, and a hot key with n option rows gets
    ceil(n / hot_rows) salts. Its option rows are spread over the salts by a
    deterministic hash and its base rows are repeated once per salt, so each
    (key, salt) task sees about hot_rows option rows. A replica of a base row
    whose salt drew no option would add a null row; hot keys always have
    options, so the salted part is an inner join and every result row appears
    exactly once. The salt is a hash of ``salt_cols`` (whole row if None), so a
    retried task sends each row to the same salt. At most one key in
    ``hot_rows`` rows is hot, so the list of hot keys is small beside the data."""
    hot = (o.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
           .where(F.col("__n") > hot_rows)
           .select(*keys, F.ceil(F.col("__n") / hot_rows).cast("int").alias("__salts")))
    if hot.isEmpty():
        return _on(b, o, keys, null_safe, "left")
    hot = guard.broadcast_if_small(cut_lineage(hot), 1_000_000)
    names = hot.select(*keys)
    row = guard.row_hash(o) if not salt_cols else F.xxhash64(*[F.col(c) for c in salt_cols])
    cold = _on(_on(b, names, keys, null_safe, "left_anti"), _on(o, names, keys, null_safe, "left_anti"),
               keys, null_safe, "left")
    options = (_on(o, hot, keys, null_safe, "inner").withColumn("__salt", F.pmod(row, F.col("__salts")))
               .drop("__salts"))
    bases = (_on(b, hot, keys, null_safe, "inner")
             .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1))).drop("__salts"))
    return cold.unionByName(_on(bases, options, [*keys, "__salt"], null_safe, "inner").drop("__salt"))


def option_only_fallback(base: DataFrame, options: DataFrame, keys: Sequence[str],
                         groups: Sequence[str], null_safe: bool = False,
                         suffixes: tuple[str, str] = ("_x", "_y"),
                         hot_rows: int | None = None,
                         salt_cols: Sequence[str] | None = None,
                         has_base: str | None = None) -> DataFrame:
    """Per group: base LEFT JOIN options when the group has any base row;
    the options unchanged (base columns null) when it has none.

    Both branches are joins (left outer, and left anti against the distinct
    base groups), so no per-group count reaches the driver. ``has_base``: an
    option column that tells already whether the row's group has any base row;
    the options are then parted by it (and it is dropped).
    """
    groups, keys = list(groups), list(keys)
    if has_base is not None:
        orphans = options.where(~F.col(has_base)).drop(has_base)
        options = options.where(F.col(has_base)).drop(has_base)
    joined = left_join_records(base, options, groups + keys, null_safe, suffixes, hot_rows,
                               salt_cols)
    b_cols = set(base.columns) - set(groups) - set(keys)
    if has_base is None:
        orphans = options.join(base.select(*groups).distinct(), groups, "left_anti")
    orphans = orphans.withColumnsRenamed(
        {c: c + suffixes[1] for c in set(options.columns) & b_cols})
    return joined.unionByName(orphans, allowMissingColumns=True)


def code_list(spark, mapping: Mapping[str, str], code: str = "code",
              label: str = "label") -> DataFrame:
    """A fixed code list as a two-column frame (size known from the literal)."""
    return spark.createDataFrame(list(mapping.items()), f"{code} string, {label} string")


def label_lookup(df: DataFrame, code_col: str, dim: DataFrame, dim_code: str,
                 dim_label: str, out: str = "label", max_dim_rows: int = 100_000) -> DataFrame:
    """Left lookup of a code in a dimension; unknown codes keep the code as
    label. The dimension is broadcast only when proven small."""
    d = dim.select(F.col(dim_code).alias("__code"), F.col(dim_label).alias("__label"))
    d = guard.broadcast_if_small(d, max_dim_rows)
    j = df.join(d, df[code_col] == d["__code"], "left")
    return (j.withColumn(out, F.coalesce(F.col("__label"), F.col(code_col).cast("string")))
            .drop("__code", "__label"))


# Window lengths of the index: a pattern uses the longest that fits it.
GRAM_SIZES = (8, 4, 3, 2, 1)
GRAMS_PER_PATTERN = 16      # evenly spaced windows of a pattern that may be its anchor
DIRECT_NAMES = 200          # names of a key up to which each answer is tested against all
MAX_BROADCAST_ROWS = 1_000_000


def _bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where the
    body uses it for every element of an array."""
    return F.transform(F.array(value), body)[0]


def _gram(chars: Column, at: Column, n: int) -> Column:
    """Hash of the n characters from position ``at`` (0-based) on."""
    return F.xxhash64(F.lit(n), *[F.get(chars, at + k) for k in range(n)])


def _text_grams(text: Column, sizes: Sequence[int]) -> Column:
    """Hashes of all windows of these lengths. The text becomes an array of
    characters once, so the cost is linear in its length."""
    def windows(chars):
        def of(n):
            starts = F.slice(chars, F.lit(1), F.greatest(F.size(chars) - (n - 1), F.lit(0)))
            return F.transform(starts, lambda _c, i: _gram(chars, i, n))
        return F.concat(*map(of, sizes)) if len(sizes) > 1 else of(sizes[0])
    return _bound(F.split(text, ""), windows)


def _pattern_grams(pattern: Column, n: int) -> Column:
    """Hashes of up to GRAMS_PER_PATTERN evenly spaced windows of length n."""
    def windows(chars):
        last = F.size(chars) - n
        steps = F.least(last, F.lit(GRAMS_PER_PATTERN - 1))
        at = F.transform(F.sequence(F.lit(0), steps), lambda j: F.when(
            steps > 0, F.floor(j * last / steps)).otherwise(0).cast("int"))
        return F.array_distinct(F.transform(at, lambda i: _gram(chars, i, n)))
    return _bound(F.split(pattern, ""), windows)


def _contained(texts: DataFrame, patterns: DataFrame, ids: Sequence[str], text: str,
               scope: Sequence[str] = ()) -> DataFrame:
    """(ids, pid) of the texts that contain a pattern of their scope. texts:
    ids (the scope columns among them) and text; patterns: pid, p (not empty)
    and scope.

    A q-gram index with rarest anchors. Some windows of each pattern are
    looked up among all windows of the texts (fixed lengths, so a text gives as
    many windows as it has characters, whatever it is made of; only windows of
    patterns go on). The one that the fewest texts hold becomes the pattern's
    anchor, the texts that hold it are its only candidates, and ``contains``
    decides. A pattern with a window that no text holds has no candidate.
    """
    ids, scope = list(ids), list(scope)
    length = F.length("p")
    pats = patterns.withColumn("__n", F.coalesce(*[F.when(length >= n, F.lit(n)) for n in GRAM_SIZES]))
    pats = pats.where("__n IS NOT NULL")
    sizes = sorted(r[0] for r in pats.select("__n").distinct().collect())
    if not sizes:
        return texts.select(*ids, F.lit(None).cast(patterns.schema["pid"].dataType).alias("pid")).limit(0)
    grams = F.coalesce(*[F.when(F.col("__n") == n, _pattern_grams(F.col("p"), n)) for n in sizes])
    pats = pats.withColumn("__grams", grams)
    asked = pats.select("pid", "p", *scope, F.size("__grams").alias("__k"), F.explode("__grams").alias("__g"))
    wanted = guard.broadcast_if_small(asked.select(*scope, "__g").distinct(), MAX_BROADCAST_ROWS)
    seen = texts.select(*ids, F.explode(_text_grams(F.col(text), sizes)).alias("__g"))
    met = cut_lineage(seen.join(wanted, [*scope, "__g"]).select(*ids, "__g").distinct())
    held_by = met.groupBy(*scope, "__g").agg(F.count(F.lit(1)).alias("__texts"))
    anchors = (asked.join(held_by, [*scope, "__g"]).groupBy("pid", "p", *scope, "__k")
               .agg(F.min(F.struct("__texts", "__g")).alias("__a"), F.count(F.lit(1)).alias("__met"))
               .where("__met = __k").select("pid", "p", *scope, F.col("__a.__g").alias("__g")))
    near = cut_lineage(met.join(anchors, [*scope, "__g"]).select(*ids, "pid", "p").distinct())
    found = texts.select(*ids, F.col(text).alias("__text")).join(
        guard.broadcast_if_small(near, MAX_BROADCAST_ROWS), ids)
    return found.where(F.col("__text").contains(F.col("p"))).select(*ids, "pid").distinct()


def grounding(answers: DataFrame, candidates: DataFrame, key: str, answer_id: str,
              text: str, name: str, out: str = "grounded") -> DataFrame:
    """Flag each answer: 1 if any candidate name of its key occurs in it,
    0 if the key has candidates but none occurs, null if it has none. A null
    name is a candidate that occurs nowhere, an empty one occurs everywhere.

    Names are de-duplicated per key. A key with up to DIRECT_NAMES names has
    each answer tested against them, in a join on the key; the names of larger
    keys are found by their anchors (see ``_contained``), so the work of a key
    is never the product of many names and its answers.
    """
    ids = [key] if answer_id == key else [key, answer_id]
    names = candidates.select(F.col(key), F.col(name).alias("p")).distinct()
    has = names.select(key).distinct().withColumn("__has", F.lit(0))
    asked = answers.select(*ids, F.col(text).alias("__t")).distinct()
    large = names.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(
        F.col("__n") > DIRECT_NAMES).select(key)
    every = large.isEmpty()
    direct = names if every else names.join(large, key, "left_anti").unionByName(
        names.where("p = ''"))
    a, b = asked.alias("a"), direct.alias("b")
    hits = a.join(b, (F.col(f"a.{key}") == F.col(f"b.{key}")) & F.col("a.__t").contains(F.col("b.p")),
                  "left_semi").select(*ids)
    if not every:
        many = names.where("p <> ''").join(large, key, "left_semi").withColumn("pid", F.lit(1))
        hits = hits.union(_contained(asked, many, ids, "__t", [key]).select(*ids))
    hits = hits.distinct().withColumn("__hit", F.lit(1))
    return (answers.join(hits, ids, "left").join(has, key, "left")
            .withColumn(out, F.coalesce(F.col("__hit"), F.col("__has")))
            .drop("__hit", "__has"))


def containment_join(texts: DataFrame, patterns: DataFrame, text_id: str, text_col: str,
                     pattern_id: str, pattern_col: str) -> DataFrame:
    """All (text_id, pattern_id) where the pattern is a substring of the text,
    found by the patterns' rarest windows (see ``_contained``). Null patterns and
    patterns of white space only match nothing."""
    pats = (patterns.select(F.col(pattern_id).cast("long").alias("pid"), F.col(pattern_col).alias("p"))
            .where(F.col("p").rlike(r"[^\x20\x09-\x0D]")).distinct())
    asked = guard.spread(texts.select(F.col(text_id), F.col(text_col).alias("__t"))).where(
        F.col("__t").isNotNull())
    return _contained(asked, pats, [text_id], "__t").withColumnRenamed("pid", pattern_id)


SMALL_TAXONOMY = 512
SMALL_TAXONOMY_BYTES = 64 * 1024


def _classify_small(texts: DataFrame, text_col: str, tax: DataFrame, out: str, default: str) -> DataFrame:
    """``classify_by_table`` for a taxonomy that fits one row."""
    sets = (tax.where(F.col("__kw").rlike(r"[^\x20\x09-\x0D]")).groupBy("__label", "__ord")
            .agg(F.collect_set("__kw").alias("kws")))
    one = sets.agg(F.collect_list(F.struct("__label", "__ord", "kws")).alias("__tax"))

    def best(t):
        scored = F.transform("__tax", lambda x: F.struct(
            F.size(F.filter(x["kws"], lambda k: F.contains(t, k))).alias("n"), (-x["__ord"]).alias("o"),
            x["__label"].alias("l")))
        return F.array_max(F.filter(scored, lambda s: s["n"] > 0))["l"]

    found = _bound(F.lower(F.col(text_col)), best)
    return (guard.spread(texts).crossJoin(F.broadcast(one))
            .withColumn(out, F.coalesce(found, F.lit(default))).drop("__tax"))


def classify_by_table(texts: DataFrame, text_id: str, text_col: str, taxonomy: DataFrame,
                      label: str = "label", ord_col: str = "ord", kw: str = "kw",
                      out: str = "label", default: str = "") -> DataFrame:
    """Keyword classification with the taxonomy as a table (any size): the
    label with the most distinct matching keywords wins, ties go to the
    smaller ``ord``; texts without a match get ``default``. Matching is
    case-insensitive. A taxonomy proven small (SMALL_TAXONOMY keywords) travels
    as one row and is matched in an expression, without a shuffle. Beyond that keywords are
    found by ``containment_join``, counted per (text, label) with a partial
    aggregate, and the best label per text is a ``max(struct)`` aggregate."""
    tax = taxonomy.select(F.col(label).alias("__label"), F.col(ord_col).alias("__ord"),
                          F.lower(F.col(kw)).alias("__kw")).distinct()
    if guard.size_at_most(tax, SMALL_TAXONOMY, SMALL_TAXONOMY_BYTES) is not None:
        return _classify_small(texts, text_col, tax, out, default)
    kws = tax.select("__kw").distinct().withColumn("__kid", F.xxhash64("__kw"))
    low = texts.select(text_id, F.lower(F.col(text_col)).alias("__t"))
    found = containment_join(low, kws.select("__kid", "__kw"), text_id, "__t", "__kid", "__kw")
    scored = (found.join(kws, "__kid").join(tax, "__kw")
              .groupBy(text_id, "__label", "__ord").agg(F.count(F.lit(1)).alias("__n")))
    best = (scored.groupBy(text_id)
            .agg(F.max(F.struct(F.col("__n"), (-F.col("__ord")).alias("__o"),
                                F.col("__label"))).alias("__b"))
            .select(text_id, F.col("__b.__label").alias("__best")))
    return (texts.join(best, text_id, "left")
            .withColumn(out, F.coalesce(F.col("__best"), F.lit(default))).drop("__best"))
