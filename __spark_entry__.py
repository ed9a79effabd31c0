"""

``entry`` runs the flagship (batch recommend) at sf0.001; ``queries`` maps
each key to a Spark job over whole tables; ``oracle_sql`` gives the same
result in plain SQL for an independent engine. Column names and types
match between the two. Where the driver tables lack the condition an
operator handles (nulls, padding, bad JSON), the Spark side makes it from
the table itself, as listed per key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prodsearch import schemas as S
from prodsearch.functions import text as TX
from prodsearch.operators import cells, clean, dialog, guard, joins, retrieve, stats
from prodsearch.plans import collect, preprocess, recommend
from prodsearch.session import cut_lineage, ensure_checkpoint_dir
from prodsearch.sources import files, pages, tables

try:  # the training-data operators are an optional part
    import corpus_pipeline
    from prodsearch.llm import queries as llm_queries
except ImportError as e:
    if e.name not in ("corpus_pipeline", "prodsearch.llm"):
        raise                       # it is there, but something it needs is not
    llm_queries = corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"
TYPES = ["deposit", "saving", "annuity", "mortgage", "rent", "credit"]
QUESTIONS = ["정기예금 추천해줘", "적금 비교", "hello"]

# Driver-table stand-ins for the operator parameters.
MARK = "tion"                   # marker searched in assistant text
MARK_RE = r"\Qtion\E"
CAP = 4                         # history cap (driver conversations hold 2-8)
OVERFLOW_MAX = 6                # overflow threshold; keeps int(6 * 0.7) = 4
REGION = "020000"
PART_RULES = [
    ("contains", "cold", "deposit"),
    ("equals", "blue bolt", "saving"),
    ("contains_not", ("widget", "small"), "credit"),
    ("contains_any", ("ring", "gear"), "annuity"),
]
DOC_TAXONOMY = [("deposit", ["tion", "ment"]), ("saving", ["und", "sch"]),
                ("credit", ["que", "les"])]
PART_SPEC = [("name", "p_name", ""), ("company", "p_brand", ""), ("type", "p_type", ""),
             ("rate", "p_retailprice", "%", "%.2f")]
PREP_SPEC = [("name", "p_name", ""), ("company", "p_brand", ""),
             ("rate", "p_retailprice", "%", "%.2f")]


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return tables.table(spark, d, name)


def _dealt(spark, d, name):
    """A table whose rows meet heavy expressions, dealt over all cores."""
    return guard.spread(_t(spark, d, name))


def _part_nulled(spark, d):
    """part with p_type null where ECONOMY (the tables hold no nulls)."""
    return _t(spark, d, "part").withColumn("p_type", F.nullif(F.col("p_type"), F.lit("ECONOMY")))


def _scratch(spark, name):
    """A folder of its own in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _k(col="props"):
    return F.get_json_object(F.col(col), "$.k")


# ---------------------------------------------------------------------------
# Sources (S1-S3, S8, S9)
# ---------------------------------------------------------------------------

def q_pages_explode(spark, d):
    """Orders + their lineitems packed as page JSON, parsed back and the
    option records exploded to typed columns."""
    types = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_linenumber": "int",
             "l_quantity": "double"}
    o = _t(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    li = _t(spark, d, "lineitem").select(*types)
    env = pages.pack_pages(o, li, "l_orderkey", division="D")
    parsed = pages.parse_pages(env, "page_json")
    recs = pages.explode_records(parsed, "optionList", group=["l_orderkey"], page="pageNo")
    recs = recs.drop("l_orderkey")
    return pages.records_to_columns(recs, list(types), types).select(*types)


def q_envelope_quarantine(spark, d):
    """Events as landed pages: error events are cut-off JSON, events without
    the entry k lack the result object."""
    ev = _dealt(spark, d, "events")
    page = (F.when(F.col("event_type") == "error", F.lit('{"result": '))
            .when(_k().isNull(), F.lit('{"other": 1}'))
            .otherwise(F.concat(F.lit('{"result": {"total_count": '), _k(), F.lit("}}"))))
    _, bad = pages.quarantine(pages.parse_pages(ev.withColumn("page_json", page), "page_json"))
    return bad.select("event_id", "event_type")


def q_group_completeness(spark, d):
    """Conversations as groups, messages as their pages (system messages
    failed to load); some envelopes lack the page count or the division."""
    c = _t(spark, d, "conversations")
    last = c.groupBy("conv_id").agg((F.max("turn") + 1).cast("long").alias("n"))
    result = F.struct(
        F.lit(1).cast("long").alias("total_count"),
        F.when(F.col("conv_id") % 3 != 0, F.col("n")).alias("max_page_no"),
        F.when(F.col("conv_id") % 2 == 0, F.lit("D")).alias("prdt_div"))
    landed = c.join(last, "conv_id").select(
        F.col("conv_id").cast("string").alias("api"), F.lit(REGION).alias("region_code"),
        (F.col("turn") + 1).cast("long").alias("pageNo"),
        F.when(F.col("role") != "system", result).alias("result"),
        F.lit(None).cast("string").alias("_corrupt_record"))
    return pages.complete_groups(landed).drop("region_code")


def q_union_typed_sources(spark, d):
    cust = _t(spark, d, "customer").select(F.col("c_name").alias("name"),
                                           F.col("c_acctbal").alias("bal"),
                                           F.col("c_mktsegment").alias("segment"))
    supp = _t(spark, d, "supplier").select(F.col("s_name").alias("name"),
                                           F.col("s_acctbal").alias("bal"))
    return files.union_typed({"customer": cust, "supplier": supp})


def q_latest_snapshot(spark, d):
    ev = _t(spark, d, "events")
    return files.latest_per_group(ev, ["event_type"], F.to_date("ts")).select(
        "event_id", "event_type")


def q_raw_csv_source(spark, d):
    """part landed as raw CSV (quotes, line breaks and empty cells in it, a
    byte order mark before the header) and read back by header."""
    p = _part_nulled(spark, d).select(
        "p_partkey", "p_type", F.lpad("p_size", 6, "0").alias("code"),
        F.concat("p_brand", F.lit('\n"'), "p_name", F.lit('", x')).alias("note"), "p_retailprice")
    path = f"{_scratch(spark, 'raw')}/D_20250714_175227.csv"
    files.land_csv(p, path)
    want = T.StructType.fromDDL("p_partkey long, p_type string, code string, note string, "
                                "p_retailprice double, absent string")
    raw = files.with_snapshot(files.read_raw_csv(spark, path, want))
    return raw.select(*want.names, "prdt_div", "snapshot_ts")


def _part_records(spark, d, snapshot_ts):
    """part as collected records; the size gives the division."""
    p = _t(spark, d, "part")
    letter = F.element_at(F.array(*map(F.lit, S.DIVISION_TYPES)), (F.col("p_size") % 6 + 1).cast("int"))
    return p.select(letter.alias("prdt_div"), F.lit(snapshot_ts).alias("snapshot_ts"),
                    F.create_map(F.lit("key"), F.col("p_partkey").cast("string"),
                                 F.lit("name"), F.col("p_name")).alias("rec"), "p_partkey", "p_size")


def _written_snapshots(spark, d):
    """Folders of records and counts: a snapshot of large parts written twice,
    the first time with all parts, then a newer one of cheap brands only."""
    out = _scratch(spark, "snapshots")
    runs = [("20250101_000000", F.lit(True)), ("20250101_000000", F.col("p_size") > 5),
            ("20250201_000000", F.col("prdt_div").isin("D", "S") & (F.col("p_size") > 20))]
    for ts, keep in runs:
        written = files.write_raw(_part_records(spark, d, ts).where(keep), f"{out}/records") or {}
        counts = spark.createDataFrame([(k, n, n, ts) for k, n in written.items()],
                                       "prdt_div string, records long, reported long, snapshot_ts string")
        files.write_counts(counts, f"{out}/counts")
    return f"{out}/records", f"{out}/counts"


def q_committed_snapshots(spark, d):
    records, counts = _written_snapshots(spark, d)
    return files.committed(spark, records, counts).select(
        "prdt_div", "snapshot_ts", F.col("rec")["key"].cast("long").alias("p_partkey"))


def q_written_counts(spark, d):
    """Records per division as observed by the writes."""
    _, counts = _written_snapshots(spark, d)
    return spark.read.parquet(counts).select("prdt_div", F.col("snapshot_ts").cast("string"), "records")


def q_latest_snapshot_pruned(spark, d):
    records, counts = _written_snapshots(spark, d)
    return files.latest_snapshots(spark, records, counts).select(
        "prdt_div", "snapshot_ts", F.col("rec")["key"].cast("long").alias("p_partkey"))


def q_processed_rewrite(spark, d):
    """Processed products of all types, then one type written again."""
    out = _scratch(spark, "processed")
    p = _t(spark, d, "part").select(
        "p_partkey", F.element_at(F.array(*map(F.lit, TYPES)), (F.col("p_size") % 6 + 1).cast("int"))
        .alias("product_type"))
    files.write_processed(p, out)
    files.write_processed(p.where("product_type = 'rent' AND p_partkey % 2 = 0"), out)
    return spark.read.parquet(out).select("p_partkey", F.col("product_type").cast("string"))


# ---------------------------------------------------------------------------
# Projection, filters, predicates
# ---------------------------------------------------------------------------

def q_core_projection(spark, d):
    return clean.core_projection(_t(spark, d, "part"), ["p_brand", "p_name", "p_size", "p_absent"])


def q_drop_missing_keys(spark, d):
    return clean.drop_missing(_part_nulled(spark, d), ["p_type"]).select("p_partkey", "p_type")


def q_tag_region(spark, d):
    o = clean.tag_constants(_t(spark, d, "orders"),
                            {"region_code": REGION, "region_name": S.REGION_CODES[REGION]})
    return o.select("o_orderkey", "region_code", "region_name")


def q_code_label_lookup(spark, d):
    c = _t(spark, d, "customer")
    out = joins.label_lookup(c, "c_nationkey", _t(spark, d, "region"), "r_regionkey", "r_name")
    return out.select("c_custkey", "c_nationkey", "label")


def q_category_rules(spark, d):
    p = _t(spark, d, "part")
    return p.select("p_partkey", TX.category_to_type("p_name", PART_RULES).alias("target_type"))


def q_required_fields(spark, d):
    p = clean.required_fields(_part_nulled(spark, d), ["p_name", "p_brand", "p_type"])
    return p.select("p_partkey", "p_name", "p_type")


def q_fill_defaults(spark, d):
    p = clean.fill_defaults(_part_nulled(spark, d), {"p_type": S.OTHER_TYPE})
    return p.select("p_partkey", "p_type")


def q_pack_raw(spark, d):
    p = clean.pack_raw(_t(spark, d, "part"))
    raw = F.col("raw_data")
    return p.select("p_partkey", raw["p_partkey"].alias("raw_key"), raw["p_name"].alias("raw_name"),
                    raw["p_brand"].alias("raw_brand"), raw["p_type"].alias("raw_type"),
                    raw["p_size"].alias("raw_size"), raw["p_retailprice"].cast("double").alias("raw_price"),
                    F.size(raw).cast("long").alias("n_entries"))


def q_normalize_roles(spark, d):
    return clean.normalize_roles(_t(spark, d, "conversations")).select("conv_id", "turn", "role")


# ---------------------------------------------------------------------------
# Joins (J1-J4)
# ---------------------------------------------------------------------------

def q_base_option_left_join(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    li = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"),
                                         "l_linenumber", "l_quantity")
    return joins.left_join_records(o, li, ["o_orderkey"], hot_rows=joins.DEFAULT_HOT_ROWS,
                                   salt_cols=["l_linenumber"])


def q_company_option_left_join(spark, d):
    n = _t(spark, d, "nation").select("n_nationkey", "n_name")
    s = _t(spark, d, "supplier").select(F.col("s_nationkey").alias("n_nationkey"),
                                        "s_suppkey", "s_name")
    return joins.left_join_records(n, s, ["n_nationkey"], hot_rows=joins.DEFAULT_HOT_ROWS,
                                   salt_cols=["s_suppkey"])


def q_option_only_fallback(spark, d):
    """Groups are days: orders of a day are the base, lineitems shipped that
    day the options, joined on the order key. Days with shipments but no
    orders (e.g. after the last order date) keep their options as is."""
    base = _t(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").alias("k"),
                                         F.to_date("o_orderdate").alias("g"))
    opt = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"),
                                          F.to_date("l_shipdate").alias("g"),
                                          "l_orderkey", "l_linenumber")
    return joins.option_only_fallback(base, opt, ["k"], ["g"], hot_rows=joins.DEFAULT_HOT_ROWS,
                                      salt_cols=["l_linenumber"]).select(
        "o_orderkey", "k", "g", "l_orderkey", "l_linenumber")


def _answers_and_names(spark, d):
    """Assistant messages as answers, the long words of users as names."""
    c = _t(spark, d, "conversations")
    answers = c.where(F.col("role") == "assistant").select("conv_id", "turn", "text")
    long_words = F.filter(F.split("text", " "), lambda w: F.length(w) >= 10)
    names = c.where(F.col("role") == "user").select("conv_id", F.explode(long_words).alias("name"))
    return answers, names


def q_answer_grounding(spark, d):
    answers, names = _answers_and_names(spark, d)
    g = joins.grounding(answers, names, "conv_id", "turn", "text", "name")
    return g.where(F.col("grounded").isNotNull()).select("conv_id", "turn", "grounded")


def q_passage_containment(spark, d):
    return joins.containment_join(_t(spark, d, "documents"), _t(spark, d, "benchmark"),
                                  "doc_id", "text", "item_id", "text")


# ---------------------------------------------------------------------------
# Aggregations
# ---------------------------------------------------------------------------

def q_division_counts(spark, d):
    ev = _t(spark, d, "events")
    return stats.division_counts(ev, "event_type", ["user_id"], _k().try_cast("int"))


def q_collection_summary(spark, d):
    return stats.collection_summary(_t(spark, d, "events"), "event_type")


def q_product_company_counts(spark, d):
    return stats.product_company_counts(_t(spark, d, "part"), ["p_type"], "p_brand")


def q_distinct_sketches(spark, d):
    """Parts shipped per return flag, from sketches stored per ship year and
    merged; beside them the exact counts. Merging must give what one sketch
    of all rows gives, up to the sketches' error."""
    li = _t(spark, d, "lineitem").withColumn("snapshot_ts", F.year("l_shipdate"))
    out = _scratch(spark, "sketches")
    (stats.distinct_sketches(li, ["l_returnflag", "snapshot_ts"], "l_partkey")
     .write.partitionBy("snapshot_ts").parquet(out))
    merged = stats.merged_distinct(spark.read.parquet(out), ["l_returnflag"])
    anew = stats.merged_distinct(stats.distinct_sketches(li, ["l_returnflag"], "l_partkey"), ["l_returnflag"])
    exact = stats.product_company_counts(li, ["l_returnflag"], "l_partkey")
    j = merged.join(anew.select("l_returnflag", F.col("n_distinct").alias("anew")), "l_returnflag").join(
        exact, "l_returnflag")
    return j.select("l_returnflag", "n_rows", F.col("n_companies").alias("n_exact"),
                    (F.abs(F.col("n_distinct") - F.col("n_companies")) <= 0.02 * F.col("n_companies"))
                    .alias("within_2_pct"),
                    (F.abs(F.col("n_distinct") - F.col("anew")) <= 0.02 * F.col("anew")).alias("merges"))


def q_top_companies(spark, d):
    return stats.top_values(_t(spark, d, "part"), ["p_type"], "p_brand", 5)


def q_rate_stats(spark, d):
    return stats.range_stats(_t(spark, d, "lineitem"), ["l_returnflag"],
                             ["l_discount", "l_tax"], mean_digits=6)


def q_rate_stats_text(spark, d):
    return stats.range_text(_t(spark, d, "part"), ["p_type"], "p_retailprice",
                            "price_range", "price_mean")


def q_category_distribution(spark, d):
    return stats.value_distribution(_part_nulled(spark, d), ["p_size"], "p_type")


def q_availability_ratio(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "lang")
    lab = _t(spark, d, "labels").select("doc_id", "quality")
    j = docs.join(lab, "doc_id", "left")
    return stats.availability_ratio(j, ["lang"], F.col("quality").isNotNull())


def q_type_distribution(spark, d):
    return stats.type_distribution(_t(spark, d, "events"), "event_type")


def q_step_audit(spark, d):
    return stats.step_audit(_part_nulled(spark, d), F.col("p_type").isNotNull(),
                            ["p_brand", "p_name"])


def q_turn_counts(spark, d):
    return stats.turn_counts(_t(spark, d, "conversations"))


def q_keep_first_dedup(spark, d):
    p = _t(spark, d, "part")
    return clean.keep_first(p, ["p_brand", "p_name"], ["p_partkey"]).select(
        "p_partkey", "p_brand", "p_name")


# ---------------------------------------------------------------------------
# Conversation windows
# ---------------------------------------------------------------------------

def q_last_n_messages(spark, d):
    return dialog.last_n(_t(spark, d, "conversations"), CAP).select("conv_id", "turn", "role")


def q_overflow_trim(spark, d):
    c = _t(spark, d, "conversations")
    return dialog.overflow_trim(c, OVERFLOW_MAX, S.OVERFLOW_KEEP_RATIO, "auto").select(
        "conv_id", "turn", "role")


def q_last_marked_message(spark, d):
    c = clean.normalize_roles(_t(spark, d, "conversations"))
    cond = dialog.is_assistant() & F.col("text").contains(MARK) & F.col("text").contains("th")
    return dialog.newest_where(c, cond, "text")


def q_window_marked_message(spark, d):
    c = clean.normalize_roles(_t(spark, d, "conversations"))
    return dialog.context_note(c, MARK_RE)


def q_last_assistant_message(spark, d):
    c = clean.normalize_roles(_t(spark, d, "conversations"))
    return dialog.newest_where(c, dialog.is_assistant(), "text")


def q_overflow_counts(spark, d):
    c = _t(spark, d, "conversations")
    return dialog.overflow_counts(c, OVERFLOW_MAX, S.OVERFLOW_KEEP_RATIO, "auto")


def q_last_recommended(spark, d):
    """Newest assistant message holding both markers, with the value after
    each marker on its first marked line."""
    c = clean.normalize_roles(_t(spark, d, "conversations"))
    return dialog.last_recommended(c, MARK, "th").select("conv_id", "product", "company")


def q_context_note_oldest(spark, d):
    """The compat choice: the oldest marked message of the last six."""
    c = clean.normalize_roles(_t(spark, d, "conversations"))
    return dialog.context_note(c, MARK_RE, oldest=True)


def q_append_and_cap(spark, d):
    """Each conversation gets one more turn (its last text asked again and
    a derived answer), then the history is capped."""
    c = _t(spark, d, "conversations")
    new = c.groupBy("conv_id").agg(F.max_by("text", "turn").alias("question")).withColumn(
        "answer", F.concat(F.lit("re: "), F.col("question")))
    return dialog.last_n(dialog.append_turns(c, new), CAP).select("conv_id", "turn", "role")


# ---------------------------------------------------------------------------
# Retrieval, ranking, top-k
# ---------------------------------------------------------------------------

def _emb(spark, d):
    return _t(spark, d, "embeddings")


def _topk(spark, d, k=3, **kw):
    e = _emb(spark, d)
    return retrieve.vector_topk(e, e.select(F.col("vec_id").alias("query_id"), "embedding"), k,
                                product_id="vec_id", query_id="query_id", exclude_self=True, **kw)


def q_vector_topk(spark, d):
    return _topk(spark, d)


def _cells(spark, d):
    e = _emb(spark, d)
    index = cells.build(e, cells.scratch_path(spark), key="vec_id", payload=["label"])
    return index, e.select(F.col("vec_id").alias("query_id"), "embedding")


def q_vector_topk_cells(spark, d):
    """The exact top-3 by the cell index: the nearest cells first, then those
    that can still hold a better vector."""
    index, asked = _cells(spark, d)
    return cells.topk(index, asked, 3, exact=True, product_id="vec_id", exclude_self=True).drop("label")


def q_vector_topk_recall(spark, d):
    """Recall of the probed cells alone against the exact top-3, with as many
    probes as a sample of the queries asks for."""
    index, asked = _cells(spark, d)
    probes = cells.calibrate(index, asked, 3, exclude_self=True)
    found = cells.topk(index, asked, 3, probes=probes, product_id="vec_id", exclude_self=True)
    r = cells.recall(found, _topk(spark, d), product_id="vec_id")
    return r.select("n_queries", "expected", (F.col("recall") >= 0.95).alias("recall_at_least_95"))


def _with_fallback(spark, d):
    """Top-3 with the product label carried through the scan (no join back
    to the product side); the wanted type is the query's own label."""
    e = _emb(spark, d)
    top = _topk(spark, d, payload=["label"])
    top = top.join(e.select(F.col("vec_id").alias("query_id"), F.col("label").alias("target")),
                   "query_id")
    return retrieve.category_fallback(top, "query_id", "label", "target", out_hit="hit")


def q_topk_category_fallback(spark, d):
    return _with_fallback(spark, d).select("query_id", "vec_id", "label", "score", "rank")


def q_ranked_results(spark, d):
    """The top-10 per query re-ranked by the score rounded to 3 digits."""
    top = _topk(spark, d, k=10, keep_raw=True)
    r = retrieve.rank_results(top.withColumn("score", F.col("raw_score")), ["query_id"],
                              "score", "vec_id", out="rank", digits=S.SCORE_DIGITS)
    return r.select("query_id", "vec_id", "score", "rank")


def _checksum(v):
    """All components of a vector in one number: each times its place."""
    return F.aggregate(F.transform(v, lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda a, x: a + x)


def q_best_result(spark, d):
    e = _emb(spark, d)
    score = F.round(_checksum("embedding"), S.SCORE_DIGITS)
    return retrieve.best_per_group(e, ["label"], score, "vec_id", ["vec_id"])


def q_comparison_list(spark, d):
    p = _t(spark, d, "part")
    line = F.concat(F.lit("- "), F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(")"))
    return retrieve.comparison_list(p, ["p_type"], [F.col("p_retailprice").desc(),
                                                    F.col("p_partkey").asc()], 3, line)


def q_l2_normalize(spark, d):
    e = _emb(spark, d).withColumn("v3", F.transform("embedding", lambda x: x * 3))
    n = retrieve.l2_normalize(e, "v3", "unit")
    return n.select("vec_id", F.round(_checksum("unit"), 6).alias("checksum"))


def _components(df, keys):
    """Non-zero components of the embeddings as rows."""
    return (df.select(*keys, F.posexplode("embedding").alias("component", "w")).where("w <> 0")
            .select(*keys, "component", F.round(F.col("w").cast("double"), 4).alias("weight")))


def q_embed_texts(spark, d):
    _, embedded = retrieve.fit_embed(_t(spark, d, "documents").select("doc_id", "text"), "text", dim=64)
    return _components(embedded, ["doc_id"])


def q_embed_queries(spark, d):
    """The encoder of the documents applied to the messages of users."""
    model = retrieve.fit_hashing_encoder(_t(spark, d, "documents").select("text"), "text", dim=64)
    asked = _t(spark, d, "conversations").where("role = 'user'").select("conv_id", "turn", "text")
    return _components(retrieve.embed(model, asked, "text"), ["conv_id", "turn"])


def _letter_counts():
    """A deterministic encoder: how often each letter a to z occurs."""
    import numpy as np

    def encode(texts):
        raw = [np.bincount(np.frombuffer(t.encode(), np.uint8), minlength=256)[97:123] for t in texts]
        return np.array(raw, dtype=np.float32)
    return encode


def q_embed_plugged(spark, d):
    """A plugged-in encoder over all documents, 32 at a time."""
    docs = _t(spark, d, "documents").select("doc_id", "text")
    return _components(retrieve.embed_with(docs, "text", _letter_counts, dim=26), ["doc_id"])


# ---------------------------------------------------------------------------
# Scalar and text functions
# ---------------------------------------------------------------------------

def q_strip_text(spark, d):
    p = _t(spark, d, "part")
    padded = F.concat(F.lit("　"), F.col("p_name"), F.lit("\t "))
    return p.select("p_partkey", TX.strip(padded).alias("stripped"))


def q_coerce_numeric(spark, d):
    ev = _dealt(spark, d, "events")
    txt = F.concat(F.lit("  "), _k(), F.lit(" "),
                   F.when(F.col("event_type") == "error", F.lit("%")).otherwise(F.lit("")))
    return ev.select("event_id", TX.to_number(txt).alias("k"))


def q_blank_flags(spark, d):
    p = _t(spark, d, "part")
    etc = F.when(F.col("p_type") != "ECONOMY", F.col("p_type")).when(
        F.col("p_partkey") % 2 == 0, F.lit(None).cast("string")).otherwise(F.lit("   "))
    f = clean.blank_flags(p.withColumn("etc", etc), "etc", "available", "clean")
    return f.select("p_partkey", "available", "clean")


def q_search_text(spark, d):
    p = _part_nulled(spark, d)
    types = {f.name: f.dataType.simpleString() for f in p.schema.fields}
    return p.select("p_partkey", TX.search_text(types, PART_SPEC).alias("search_text"))


def q_keyword_any(spark, d):
    c = _t(spark, d, "conversations")
    return c.select("conv_id", "turn", TX.contains_any("text", [MARK, "ment"]).alias("hit"))


def q_marker_extract(spark, d):
    c = _t(spark, d, "conversations")
    return (c.where(TX.has_marker("text", MARK_RE))
            .select("conv_id", "turn", TX.marker_value("text", MARK_RE).alias("value")))


def q_parse_analysis_json(spark, d):
    ev = _dealt(spark, d, "events")
    raw = F.when(F.col("event_type") == "error",
                 F.concat(F.lit('{"user_intent": "'), F.repeat(F.col("event_type"), 20))).otherwise(
        F.concat(F.lit('{"product_category": "'), F.col("event_type"), F.lit('", "user_intent": "'),
                 F.coalesce(_k(), F.lit("none")), F.lit('"}')))
    a = recommend.analysis_from_json(ev.withColumn("raw", raw), "raw")
    return a.select("event_id", "analysis.product_category", "analysis.user_intent",
                    "analysis_error.error", "analysis_error.raw_response", "analysis_error.status")


def q_format_timestamp(spark, d):
    ev = _t(spark, d, "events")
    return ev.select("event_id", TX.stamp("ts").alias("stamp"), TX.shown("ts").alias("shown"))


def q_route_intent(spark, d):
    c = _t(spark, d, "conversations")
    intent = F.when(F.col("role") == "system", F.lit("information")).otherwise(
        F.lit("recommendation"))
    return c.select("conv_id", "turn",
                    TX.route_intent(intent, "text", [MARK], ["wh"]).alias("route"))


def _order_results(spark, d):
    """Lineitems as the ranked results of their orders."""
    place = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey",
                                                     "l_extendedprice")
    li = (_t(spark, d, "lineitem").withColumn("rank", F.row_number().over(place))
          .join(_t(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")))
    return li.select(F.col("l_orderkey").alias("query_id"), F.col("l_partkey").alias("product_id"),
                     F.col("rank").cast("long").alias("rank"), F.col("l_discount").alias("score"),
                     F.col("p_name").alias("product_name"), F.col("p_brand").alias("company"),
                     F.col("p_type").alias("product_type"), (F.col("l_returnflag") != "R").alias("valid"))


def _order_questions(spark, d):
    """Orders as questions; the status is the intent, or a failed analysis."""
    status = F.col("o_orderstatus")
    intent = F.when(status == "F", "information").when(status == "O", "comparison").otherwise("recommendation")
    error = F.struct(F.lit("JSON").alias("error"), F.col("o_orderpriority").alias("raw_response"),
                     F.lit("json_parse_error").alias("status"))
    return _t(spark, d, "orders").select(
        F.col("o_orderkey").alias("query_id"), F.col("o_custkey").alias("conv_id"),
        F.col("o_orderpriority").alias("text"), F.struct(intent.alias("user_intent")).alias("analysis"),
        F.when(status == "F", error).alias("analysis_error"))


def q_build_prompts(spark, d):
    notes = _t(spark, d, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("conv_id"), F.col("c_name").alias("note"))
    p = recommend.prompts(_order_results(spark, d), _order_questions(spark, d), notes)
    return p.select("query_id", "route", "prompt")


def q_contextual_question(spark, d):
    """User questions carry the product and the company of the newest
    message with both markers."""
    c = clean.normalize_roles(_t(spark, d, "conversations"))
    ctx = dialog.last_recommended(c, MARK, "th")
    return dialog.contextual_question(c, ctx).select("conv_id", "turn", "question")


def q_keyword_classify(spark, d):
    docs = _dealt(spark, d, "documents")
    return docs.select("doc_id", TX.classify_by_keywords("text", DOC_TAXONOMY).alias("label"))


def q_keyword_classify_table(spark, d):
    """The same classification with the taxonomy as a table."""
    docs = _t(spark, d, "documents").select("doc_id", "text")
    tax = spark.createDataFrame([(lab, i, k) for i, (lab, ks) in enumerate(DOC_TAXONOMY, 1)
                                 for k in ks], "label string, ord int, kw string")
    return joins.classify_by_table(docs, "doc_id", "text", tax).select("doc_id", "label")


def q_extract_amounts(spark, d):
    p = _dealt(spark, d, "part")
    txt = F.concat(F.col("p_size").cast("string"), F.lit("만원 "),
                   (F.col("p_size") % 7 + 1).cast("string"), F.lit("년"))
    return p.select("p_partkey", TX.amount_won(txt).alias("amount_won"),
                    TX.period_months(txt).alias("period_months"))


def q_amount_mentions(spark, d):
    """Every amount and period of texts of each form, made from part."""
    p = _dealt(spark, d, "part")
    a, y, m = F.col("p_size"), F.col("p_size") % 9 + 1, F.col("p_partkey") % 11 + 1
    a, y, m = (x.cast("string") for x in (a, y, m))

    def text(*parts):
        return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])

    forms = [text(a, "만원씩 ", y, "년 ", m, "개월, 만기 ", a, "억 ", m, "천만원"),
             text(a, ",000원을 ", y, "년 반 동안"), text(a, ".5억원, ", m, "개월 또는 ", y, "년간"),
             text("2024년에 ", a, "백만 원, 반년"), text(y, ".5년 ", m, "달 ", a, "년"), F.lit("없음")]
    t = F.element_at(F.array(*forms), (F.col("p_partkey") % 6 + 1).cast("int"))

    def listed(v):
        return F.array_join(F.transform(v, lambda x: x.cast("string")), ",")
    return p.select("p_partkey", listed(TX.amounts_won(t)).alias("amounts"),
                    listed(TX.periods_months(t)).alias("periods"),
                    TX.amount_won(t).alias("first_amount"), TX.period_months(t).alias("first_period"))


def q_final_answer(spark, d):
    answers, names = _answers_and_names(spark, d)
    g = joins.grounding(answers, names, "conv_id", "turn", "text", "name")
    fallback = F.when(F.col("turn") % 2 == 1, F.lit("base")).otherwise("")
    out = recommend.answer_cascade(F.col("grounded"), F.col("text"), fallback)
    return g.select("conv_id", "turn", out.alias("answer"))


def q_response_rows(spark, d):
    """Orders answered with their priority; pending ones failed."""
    asked = _order_questions(spark, d)
    final = _t(spark, d, "orders").select(F.col("o_orderkey").alias("query_id"), F.when(
        F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("recommendation"))
    turns = _t(spark, d, "customer").select(F.col("c_custkey").alias("conv_id"),
                                            F.col("c_nationkey").cast("long").alias("turns"))
    r = recommend.response_rows(final, _order_results(spark, d), asked, turns)
    return r.select("query_id", "status", "recommendation", "error", "conversation_turns",
                    F.col("analysis.user_intent").alias("intent"),
                    F.size("search_results").cast("long").alias("n_results"),
                    F.get("search_results", F.lit(0))["product_name"].alias("first_product"))


# ---------------------------------------------------------------------------
# End-to-end jobs
# ---------------------------------------------------------------------------

def _collected(spark, d):
    """Orders and lineitems landed as pages, an order to a group; pending
    orders are missing, so their lineitems are option-only."""
    o = _t(spark, d, "orders").where("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("fin_prdt_cd"), F.col("o_orderpriority").alias("kor_co_nm"),
        F.to_date("o_orderdate").alias("dcls_month"))
    li = _t(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("fin_prdt_cd"), F.col("l_linenumber").alias("save_trm"),
        F.to_date("l_shipdate").alias("dcls_month"))
    env = pages.pack_pages(o, li, "fin_prdt_cd", division="D")
    landed = pages.parse_pages(env, "page_json").select(
        F.col("fin_prdt_cd").cast("string").alias("api"), F.lit(REGION).alias("region_code"),
        "pageNo", "result", "_corrupt_record")
    landed = cut_lineage(landed)        # the parsed pages, as the job itself keeps them
    return landed, collect.merge_records(landed)


def q_job_collect(spark, d):
    _, recs = _collected(spark, d)
    types = {"fin_prdt_cd": "bigint", "save_trm": "int"}
    names = ["fin_prdt_cd", "save_trm", "kor_co_nm", "dcls_month", "dcls_month_x", "dcls_month_y"]
    return pages.records_to_columns(recs, names, types).select("prdt_div", *names)


def q_job_collect_counts(spark, d):
    landed, recs = _collected(spark, d)
    return collect.record_counts(recs, landed)


def q_collect_tables(spark, d):
    o = _t(spark, d, "orders")
    li = _t(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return collect.collect_tables(o, li, "o_orderkey", "o_orderstatus", REGION,
                                  row_id=["l_linenumber"])


def q_preprocess_all(spark, d):
    """The whole job over six types: part landed as six raw CSV files (and
    older ones that must not be read), preprocessed side by side and written;
    the processed products with their type's status."""
    root = _scratch(spark, "preprocess")
    p = cut_lineage(_t(spark, d, "part").repartitionByRange("p_partkey").sortWithinPartitions("p_partkey"))
    letters = list(S.DIVISION_TYPES)
    for i, letter in enumerate(letters):
        mine = p.where(F.col("p_partkey") % 6 == i)
        values = {S.COMPANY_COL: F.concat(F.lit(" "), "p_brand"), S.PRODUCT_COL: F.col("p_name"),
                  "join_way": F.col("p_partkey").cast("string")}
        rows = mine.select(*[values.get(c, F.lit(None).cast("string")).alias(c)
                             for c in S.CORE_COLUMNS[S.DIVISION_TYPES[letter]]])
        files.land_csv(rows, f"{root}/raw/{letter}_20250714_175227.csv")
        files.land_csv(rows.limit(1), f"{root}/raw/{letter}_20250101_000000.csv")
    status = preprocess.preprocess_all(spark, f"{root}/raw", f"{root}/out", "2025-07-14 17:52:27")
    done = spark.read.option("mergeSchema", True).parquet(f"{root}/out/processed")
    return (done.select(F.col("product_type").cast("string"), S.COMPANY_COL, S.PRODUCT_COL,
                        F.col("join_way").cast("long").alias("first_key"))
            .join(status.select("product_type", "status", "rows"), "product_type"))


def q_job_preprocess(spark, d):
    p = _part_nulled(spark, d)
    out = preprocess.preprocess(
        p, core=["p_partkey", "p_brand", "p_name", "p_type", "p_retailprice"],
        essentials=["p_type"], strip_cols=["p_brand", "p_name"], numeric_cols=["p_retailprice"],
        dedup_keys=["p_brand", "p_name"], order="p_partkey", spec=PREP_SPEC)
    return out.select("p_partkey", "p_brand", "p_name", "search_text")


def q_job_recommend(spark, d):
    """The whole job: every embedding is a product, named from part where it
    has one, and every embedding a question whose label gives its words; the
    conversations are the history, and answers name a product or not."""
    e = _emb(spark, d)
    part = _t(spark, d, "part").select(F.col("p_partkey").alias("vec_id"), "p_name", "p_brand")
    named = e.join(part, "vec_id", "left")
    name, label = F.coalesce("p_name", F.lit("")), F.col("label")
    products = named.select(
        F.col("vec_id").alias("product_id"), F.element_at(F.array(*map(F.lit, TYPES)), label % 6 + 1)
        .alias("product_type"), F.coalesce("p_brand", F.lit("")).alias("company"),
        name.alias("product_name"), "embedding")
    asked = e.select(F.col("vec_id").alias("query_id"), F.col("vec_id").alias("conv_id"),
                     F.element_at(F.array(*map(F.lit, QUESTIONS)), label % 3 + 1).alias("text"), "embedding")
    answers = named.select(
        F.col("vec_id").alias("query_id"),
        F.when(label % 2 == 0, F.concat(F.lit("pick "), name)).otherwise("nothing").alias("generated"),
        F.when(label % 4 == 1, F.lit("base")).otherwise("").alias("fallback"))
    out = recommend.recommend(products, asked, _t(spark, d, "conversations"), answers, k=3)
    return out["responses"].select(
        "query_id", "status", "recommendation", "conversation_turns",
        F.size("search_results").cast("long").alias("n_results"),
        F.array_join(F.transform("search_results", lambda r: r["product_name"]), "|").alias("names"))


ORACLE_ALIASES = {"keyword_classify_table": "keyword_classify", "vector_topk_cells": "vector_topk"}

_LETTER = f"{list(S.DIVISION_TYPES)}[p_size % 6 + 1]"
_SNAPSHOTS = f"""SELECT {_LETTER} AS prdt_div, '20250101_000000' AS snapshot_ts, p_partkey
        FROM part WHERE p_size > 5
        UNION ALL SELECT {_LETTER}, '20250201_000000', p_partkey FROM part
        WHERE p_size > 20 AND {_LETTER} IN ('D', 'S')"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in list(globals().items())
    if name.startswith("q_") and callable(fn)
}


# ---------------------------------------------------------------------------
# Oracle SQL
# ---------------------------------------------------------------------------

_TOPK = """SELECT q.vec_id AS query_id, e.vec_id, e.label, q.label AS target,
  list_dot_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS d,
  round(list_dot_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 6) AS score
  FROM embeddings e, embeddings q WHERE e.vec_id <> q.vec_id"""

_RANKED = """SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rank FROM lineitem"""

_CHECKSUM = "list_sum(list_transform({v}, lambda x, i: x::DOUBLE * i))"

_WORDS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')"


def _embedded(rows: str, keys: str) -> str:
    """Components of the hashed vectors of ``rows`` under the documents' weights."""
    counts = """SELECT {keys}, ('0x' || substr(md5(w), 1, 8))::BIGINT % 64 AS component, count(*) AS tf
        FROM (SELECT {keys}, unnest({words}) AS w FROM {rows}) GROUP BY ALL"""
    return f"""WITH seen AS ({counts.format(keys="doc_id", words=_WORDS, rows="documents")}),
        idf AS (SELECT b.component, ln(((SELECT count(*) FROM documents) + 1) / (count(doc_id) + 1)) AS idf
            FROM (SELECT unnest(range(64)) AS component) b LEFT JOIN seen USING (component) GROUP BY 1),
        own AS ({counts.format(keys=keys, words=_WORDS, rows=rows)}),
        w AS (SELECT {keys}, component, tf * idf AS x FROM own JOIN idf USING (component)),
        n AS (SELECT *, sqrt(sum(x * x) OVER (PARTITION BY {keys})) AS norm FROM w)
        SELECT {keys}, component::INTEGER AS component, round((x / norm)::FLOAT::DOUBLE, 4) AS weight
        FROM n WHERE norm > 0 AND x <> 0"""


_FALLBACK = f"""WITH t AS ({_TOPK}),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d DESC, vec_id) AS rank
      FROM t QUALIFY rank <= 3),
h AS (SELECT *, max(CAST(label = target AS INT)) OVER (PARTITION BY query_id) AS hit FROM r)"""

_GROUND = """SELECT a.conv_id, a.turn, a.text, max(CAST(contains(a.text, c.name) AS INT)) AS grounded
  FROM conversations a {join} (SELECT conv_id, unnest(list_filter(string_split(text, ' '),
  lambda w: length(w) >= 10)) AS name
  FROM conversations WHERE role = 'user') c ON a.conv_id = c.conv_id
  WHERE a.role = 'assistant' GROUP BY 1, 2, 3"""

ORACLE: dict[str, str] = {
    "pages_explode": "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem",
    "envelope_quarantine": """SELECT event_id, event_type FROM events
        WHERE event_type = 'error' OR json_extract_string(props, '$.k') IS NULL""",
    "group_completeness": """WITH g AS (SELECT CAST(conv_id AS VARCHAR) AS api,
            CASE WHEN conv_id % 3 = 0 THEN 1 ELSE max(turn) + 1 END::BIGINT AS max_page_no,
            1::BIGINT AS total_count,
            CASE WHEN conv_id % 2 = 0 THEN 'D' ELSE CAST(conv_id AS VARCHAR) END AS prdt_div,
            count(DISTINCT turn) FILTER (role <> 'system') AS pages_ok,
            count(DISTINCT turn) FILTER (role = 'system') AS pages_bad
            FROM conversations GROUP BY conv_id)
        SELECT * FROM g WHERE pages_ok = max_page_no""",
    "union_typed_sources": """SELECT 'customer' AS product_type, c_name AS name, c_acctbal AS bal,
        c_mktsegment AS segment FROM customer
        UNION ALL SELECT 'supplier', s_name, s_acctbal, NULL FROM supplier""",
    "raw_csv_source": """SELECT p_partkey, nullif(p_type, 'ECONOMY') AS p_type,
        lpad(CAST(p_size AS VARCHAR), 6, '0') AS code, p_brand || chr(10) || '"' || p_name || '", x' AS note,
        p_retailprice, NULL::VARCHAR AS absent, 'D' AS prdt_div, '20250714_175227' AS snapshot_ts FROM part""",
    "committed_snapshots": _SNAPSHOTS,
    "written_counts": f"""SELECT prdt_div, snapshot_ts, count(*) AS records FROM ({_SNAPSHOTS}) GROUP BY ALL""",
    "latest_snapshot_pruned": f"""SELECT * FROM ({_SNAPSHOTS})
        QUALIFY rank() OVER (PARTITION BY prdt_div ORDER BY snapshot_ts DESC) = 1""",
    "processed_rewrite": f"""SELECT * FROM (SELECT p_partkey, {TYPES}[p_size % 6 + 1] AS product_type FROM part)
        WHERE product_type <> 'rent' OR p_partkey % 2 = 0""",
    "latest_snapshot": """SELECT event_id, event_type FROM events
        QUALIFY rank() OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE) DESC) = 1""",
    "core_projection": "SELECT p_brand, p_name, p_size FROM part",
    "drop_missing_keys": """SELECT p_partkey, p_type FROM part
        WHERE nullif(p_type, 'ECONOMY') IS NOT NULL""",
    "tag_region": f"""SELECT o_orderkey, '{REGION}' AS region_code,
        '{S.REGION_CODES[REGION]}' AS region_name FROM orders""",
    "code_label_lookup": """SELECT c_custkey, c_nationkey,
        coalesce(r_name, CAST(c_nationkey AS VARCHAR)) AS label
        FROM customer LEFT JOIN region ON c_nationkey = r_regionkey""",
    "category_rules": """SELECT p_partkey, CASE
        WHEN contains(p_name, 'cold') THEN 'deposit'
        WHEN p_name = 'blue bolt' THEN 'saving'
        WHEN contains(p_name, 'widget') AND NOT contains(p_name, 'small') THEN 'credit'
        WHEN contains(p_name, 'ring') OR contains(p_name, 'gear') THEN 'annuity'
        ELSE '' END AS target_type FROM part""",
    "required_fields": """SELECT p_partkey, p_name, p_type FROM part
        WHERE p_type <> 'ECONOMY' AND trim(p_name) <> '' AND trim(p_brand) <> ''""",
    "fill_defaults": f"""SELECT p_partkey, coalesce(nullif(p_type, 'ECONOMY'), '{S.OTHER_TYPE}')
        AS p_type FROM part""",
    "pack_raw": """SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS raw_key, p_name AS raw_name,
        p_brand AS raw_brand, p_type AS raw_type, CAST(p_size AS VARCHAR) AS raw_size,
        p_retailprice AS raw_price, 6::BIGINT AS n_entries FROM part""",
    "normalize_roles": """SELECT conv_id, turn,
        CASE WHEN role = 'user' THEN 'user' ELSE 'assistant' END AS role FROM conversations""",
    "base_option_left_join": """SELECT o_orderkey, o_orderstatus, l_linenumber, l_quantity
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
    "company_option_left_join": """SELECT n_nationkey, n_name, s_suppkey, s_name
        FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey""",
    "option_only_fallback": """WITH b AS (SELECT o_orderkey, o_orderkey AS k,
            CAST(o_orderdate AS DATE) AS g FROM orders),
        o AS (SELECT l_orderkey AS k, CAST(l_shipdate AS DATE) AS g, l_orderkey, l_linenumber
            FROM lineitem)
        SELECT b.o_orderkey, b.k, b.g, o.l_orderkey, o.l_linenumber
            FROM b LEFT JOIN o ON b.k = o.k AND b.g = o.g
        UNION ALL SELECT NULL, o.k, o.g, o.l_orderkey, o.l_linenumber FROM o
            WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.g = o.g)""",
    "answer_grounding": f"""SELECT conv_id, turn, grounded FROM ({_GROUND.format(join='JOIN')})""",
    "passage_containment": """SELECT d.doc_id, b.item_id FROM documents d
        JOIN benchmark b ON contains(d.text, b.text)""",
    "division_counts": """WITH g AS (SELECT event_type, user_id, count(*) AS n,
            max(CAST(json_extract_string(props, '$.k') AS INT)) AS total
            FROM events GROUP BY 1, 2)
        SELECT event_type, CAST(sum(n) AS BIGINT) AS records, CAST(sum(total) AS BIGINT) AS reported
        FROM g WHERE n > 0 GROUP BY 1""",
    "collection_summary": """SELECT event_type, NULL::BIGINT AS n_divisions, count(*) AS n_records
            FROM events GROUP BY 1
        UNION ALL SELECT NULL, count(DISTINCT event_type), count(*) FROM events""",
    "product_company_counts": """SELECT p_type, count(*) AS n_products,
        count(DISTINCT p_brand) AS n_companies FROM part GROUP BY 1""",
    "distinct_sketches": """SELECT l_returnflag, count(*)::BIGINT AS n_rows,
        count(DISTINCT l_partkey) AS n_exact, true AS within_2_pct, true AS merges FROM lineitem GROUP BY 1""",
    "top_companies": """SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY 1, 2
        QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY count(*) DESC, p_brand) <= 5""",
    "rate_stats": """SELECT l_returnflag, 'l_discount' AS metric, min(l_discount) AS lo,
            max(l_discount) AS hi, round(avg(l_discount), 6) AS mean FROM lineitem GROUP BY 1
        UNION ALL SELECT l_returnflag, 'l_tax', min(l_tax), max(l_tax), round(avg(l_tax), 6)
            FROM lineitem GROUP BY 1""",
    "rate_stats_text": """SELECT p_type,
        printf('%.2f%% ~ %.2f%%', min(p_retailprice), max(p_retailprice)) AS price_range,
        printf('%.2f%%', avg(p_retailprice)) AS price_mean FROM part GROUP BY 1""",
    "category_distribution": """SELECT p_type, p_size, count(*) AS n FROM part
        WHERE p_type <> 'ECONOMY' GROUP BY 1, 2""",
    "availability_ratio": """SELECT d.lang, count(l.quality) AS available, count(*) AS total,
        round(100.0 * count(l.quality) / count(*), 4) AS pct
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""",
    "type_distribution": """SELECT coalesce(event_type, 'ALL') AS event_type, count(*) AS n,
        format('{:,}', count(*)) AS n_text FROM events GROUP BY ROLLUP (event_type)""",
    "step_audit": """SELECT count(*) AS n_in,
        count(*) FILTER (WHERE p_type <> 'ECONOMY') AS n_after_drop,
        count(DISTINCT CASE WHEN p_type <> 'ECONOMY' THEN concat(p_brand, '/', p_name) END)
            AS n_after_dedup FROM part""",
    "turn_counts": "SELECT conv_id, count(*) // 2 AS turns FROM conversations GROUP BY 1",
    "keep_first_dedup": """SELECT p_partkey, p_brand, p_name FROM part
        QUALIFY row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_partkey) = 1""",
    "last_n_messages": f"""SELECT conv_id, turn, role FROM conversations
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= {CAP}""",
    "overflow_trim": f"""SELECT conv_id, turn, role FROM conversations
        QUALIFY count(*) OVER (PARTITION BY conv_id) < {OVERFLOW_MAX}
        OR row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC)
            <= {int(OVERFLOW_MAX * S.OVERFLOW_KEEP_RATIO)}""",
    "last_marked_message": f"""SELECT conv_id, arg_max(text, turn) AS text FROM conversations
        WHERE role <> 'user' AND contains(text, '{MARK}') AND contains(text, 'th') GROUP BY 1""",
    "window_marked_message": f"""WITH w AS (SELECT * FROM conversations
            QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC)
                <= {S.CONTEXT_WINDOW})
        SELECT conv_id, concat('{S.CONTEXT_NOTE_PREFIX}',
            substr(arg_max(text, turn), 1, {S.CONTEXT_NOTE_CHARS}), '...') AS note
        FROM w WHERE role <> 'user' AND contains(text, '{MARK}') GROUP BY 1""",
    "last_assistant_message": """SELECT conv_id, arg_max(text, turn) AS text FROM conversations
        WHERE role <> 'user' GROUP BY 1""",
    "overflow_counts": f"""SELECT conv_id,
        CAST(CASE WHEN count(*) >= {OVERFLOW_MAX}
             THEN least(count(*), {int(OVERFLOW_MAX * S.OVERFLOW_KEEP_RATIO)})
             ELSE count(*) END AS BIGINT) AS kept,
        CAST(count(*) - CASE WHEN count(*) >= {OVERFLOW_MAX}
             THEN least(count(*), {int(OVERFLOW_MAX * S.OVERFLOW_KEEP_RATIO)})
             ELSE count(*) END AS BIGINT) AS dropped
        FROM conversations GROUP BY 1""",
    "last_recommended": f"""WITH m AS (SELECT conv_id, arg_max(text, turn) AS text
            FROM conversations WHERE role <> 'user' AND contains(text, '{MARK}')
            AND contains(text, 'th') GROUP BY 1)
        SELECT conv_id,
            trim(split_part(regexp_extract(text, '[^\\n]*{MARK}[^\\n]*'), '{MARK}', 2))
                AS product,
            trim(split_part(regexp_extract(text, '[^\\n]*th[^\\n]*'), 'th', 2)) AS company
        FROM m""",
    "context_note_oldest": f"""WITH w AS (SELECT * FROM conversations
            QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC)
                <= {S.CONTEXT_WINDOW})
        SELECT conv_id, concat('{S.CONTEXT_NOTE_PREFIX}',
            substr(arg_min(text, turn), 1, {S.CONTEXT_NOTE_CHARS}), '...') AS note
        FROM w WHERE role <> 'user' AND contains(text, '{MARK}') GROUP BY 1""",
    "append_and_cap": f"""WITH m AS (SELECT conv_id, max(turn) AS t FROM conversations GROUP BY 1),
        u AS (SELECT conv_id, turn, role FROM conversations
              UNION ALL SELECT conv_id, t + 1, 'user' FROM m
              UNION ALL SELECT conv_id, t + 2, 'assistant' FROM m)
        SELECT conv_id, turn, role FROM u
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= {CAP}""",
    "vector_topk": f"""SELECT query_id, vec_id, score, row_number() OVER
        (PARTITION BY query_id ORDER BY d DESC, vec_id) AS rank FROM ({_TOPK})
        QUALIFY rank <= 3""",
    "topk_category_fallback": f"""{_FALLBACK}
        SELECT query_id, vec_id, label, score, rank FROM h WHERE hit = 0 OR label = target""",
    "ranked_results": f"""WITH t AS (SELECT *, row_number() OVER
            (PARTITION BY query_id ORDER BY d DESC, vec_id) AS r0 FROM ({_TOPK})
            QUALIFY r0 <= 10)
        SELECT query_id, vec_id, round(d, 3) AS score, row_number() OVER
            (PARTITION BY query_id ORDER BY round(d, 3) DESC, vec_id) AS rank FROM t""",
    "best_result": f"""SELECT label, vec_id FROM embeddings QUALIFY row_number() OVER
        (PARTITION BY label ORDER BY round({_CHECKSUM.format(v="embedding")}, 3) DESC, vec_id) = 1""",
    "comparison_list": """WITH r AS (SELECT *, row_number() OVER
            (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) AS rank
            FROM part QUALIFY rank <= 3)
        SELECT p_type, string_agg(concat('- ', p_name, ' (', p_brand, ')'), chr(10) ORDER BY rank)
            AS lines FROM r GROUP BY 1""",
    "l2_normalize": f"""SELECT vec_id, round({_CHECKSUM.format(v="embedding")}
        / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS checksum
        FROM embeddings""",
    "vector_topk_recall": """SELECT count(*) AS n_queries, 3 * count(*) AS expected, true AS recall_at_least_95
        FROM embeddings""",
    "embed_plugged": """WITH n AS (SELECT doc_id, c.i AS component, (length(text)
            - length(replace(text, chr(97 + c.i), '')))::DOUBLE AS x
            FROM documents, (SELECT unnest(range(26))::INTEGER AS i) c)
        SELECT doc_id, component, round((x / norm)::FLOAT::DOUBLE, 4) AS weight
        FROM (SELECT *, sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS norm FROM n) WHERE x > 0""",
    "embed_texts": _embedded("documents", "doc_id"),
    "embed_queries": _embedded("(SELECT * FROM conversations WHERE role = 'user')", "conv_id, turn"),
    "strip_text": "SELECT p_partkey, p_name AS stripped FROM part",
    "coerce_numeric": """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
        ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k FROM events""",
    "blank_flags": """SELECT p_partkey, p_type <> 'ECONOMY' AS available,
        CASE WHEN p_type = 'ECONOMY' THEN '' ELSE p_type END AS clean FROM part""",
    "search_text": """SELECT p_partkey, concat_ws(chr(10), concat('name: ', p_name),
        concat('company: ', p_brand), concat('type: ', coalesce(nullif(p_type, 'ECONOMY'), 'N/A')),
        concat('rate: ', printf('%.2f', p_retailprice), '%')) AS search_text FROM part""",
    "keyword_any": f"""SELECT conv_id, turn, contains(lower(text), '{MARK}')
        OR contains(lower(text), 'ment') AS hit FROM conversations""",
    "marker_extract": f"""SELECT conv_id, turn,
        trim(split_part(regexp_extract(text, '[^\\n]*{MARK}[^\\n]*'), '{MARK}', 2)) AS value
        FROM conversations WHERE contains(text, '{MARK}')""",
    "parse_analysis_json": f"""SELECT event_id,
        CASE WHEN event_type <> 'error' THEN event_type END AS product_category,
        CASE WHEN event_type <> 'error' THEN coalesce(json_extract_string(props, '$.k'), 'none') END
            AS user_intent,
        CASE WHEN event_type = 'error' THEN 'JSON 파싱 실패' END AS error,
        CASE WHEN event_type = 'error' THEN concat(substr(concat('{{"user_intent": "',
            repeat(event_type, 20)), 1, {S.RAW_RESPONSE_CHARS}), '...') END AS raw_response,
        CASE WHEN event_type = 'error' THEN 'json_parse_error' END AS status FROM events""",
    "format_timestamp": """SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown FROM events""",
    "route_intent": f"""SELECT conv_id, turn, CASE
        WHEN role = 'system' OR contains(lower(text), '{MARK}') THEN 'information'
        WHEN contains(lower(text), 'wh') THEN 'comparison' ELSE 'recommendation' END AS route
        FROM conversations""",
    "build_prompts": f"""WITH v AS (SELECT l_orderkey, l_discount, p_name, p_brand, p_type,
            row_number() OVER (PARTITION BY l_orderkey ORDER BY rank) AS rn
            FROM ({_RANKED}) JOIN part ON l_partkey = p_partkey WHERE l_returnflag <> 'R'),
        comp AS (SELECT l_orderkey, string_agg(concat('- ', p_name, ' (', p_brand, ')'), chr(10)
            ORDER BY rn) AS lines FROM v WHERE rn <= 3 GROUP BY 1),
        q AS (SELECT o_orderkey AS query_id, o_orderpriority AS text, v.*, lines,
            CASE o_orderstatus WHEN 'F' THEN 'information' WHEN 'O' THEN 'comparison'
                ELSE 'recommendation' END AS route, coalesce(c_name, '') AS note
            FROM orders JOIN v ON o_orderkey = v.l_orderkey AND rn = 1
            JOIN comp ON o_orderkey = comp.l_orderkey
            LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0)
        SELECT query_id, route, CASE route
            WHEN 'information' THEN concat('사용자 질문: ', text, chr(10), note, chr(10), '상품명: ', p_name,
                chr(10), '금융회사: ', p_brand, chr(10), '상품 유형: ', p_type, chr(10), '상세 정보: {{}}')
            WHEN 'comparison' THEN concat('사용자 질문: ', text, chr(10), note, chr(10),
                '비교 대상 상품들:', chr(10), lines)
            ELSE concat(note, chr(10), '사용자 질문: ', text, chr(10), '상품명: ', p_name, chr(10),
                '금융회사: ', p_brand, chr(10), '유사도: ', l_discount, chr(10), '상세 정보: {{}}') END
            AS prompt FROM q""",
    "contextual_question": f"""WITH l AS (SELECT conv_id, arg_max(text, turn) AS text
            FROM conversations WHERE role <> 'user' AND contains(text, '{MARK}')
            AND contains(text, 'th') GROUP BY 1),
        m AS (SELECT conv_id,
            trim(split_part(regexp_extract(text, '[^\\n]*{MARK}[^\\n]*'), '{MARK}', 2)) AS product,
            trim(split_part(regexp_extract(text, '[^\\n]*th[^\\n]*'), 'th', 2)) AS company FROM l)
        SELECT c.conv_id, c.turn, CASE WHEN product IS NULL THEN c.text
            ELSE concat('이전 추천 상품: ', product, ' (', company, ')', chr(10), '질문: ', c.text) END
            AS question
        FROM conversations c LEFT JOIN m ON c.conv_id = m.conv_id WHERE c.role = 'user'""",
    "keyword_classify": """WITH tax(label, ord, kw) AS (VALUES ('deposit', 1, 'tion'),
            ('deposit', 1, 'ment'), ('saving', 2, 'und'), ('saving', 2, 'sch'),
            ('credit', 3, 'que'), ('credit', 3, 'les')),
        s AS (SELECT d.doc_id, t.label, t.ord, count(*) AS n FROM documents d
            JOIN tax t ON contains(lower(d.text), t.kw) GROUP BY 1, 2, 3),
        b AS (SELECT doc_id, label FROM s
            QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, ord) = 1)
        SELECT d.doc_id, coalesce(label, '') AS label FROM documents d
            LEFT JOIN b ON d.doc_id = b.doc_id""",
    "amount_mentions": """WITH v AS (SELECT p_partkey, p_partkey % 6 AS form, p_size::BIGINT AS a,
            p_size % 9 + 1 AS y, p_partkey % 11 + 1 AS m FROM part),
        l AS (SELECT p_partkey, CASE form WHEN 0 THEN [a * 10000, a * 100000000 + m * 10000000]
            WHEN 1 THEN [a * 1000] WHEN 2 THEN [a * 100000000 + 50000000] WHEN 3 THEN [a * 1000000]
            ELSE [] END::BIGINT[] AS won, CASE form WHEN 0 THEN [12 * y + m] WHEN 1 THEN [12 * y + 6]
            WHEN 2 THEN [m, 12 * y] WHEN 3 THEN [6] WHEN 4 THEN [12 * y + 6 + m, 12 * a]
            ELSE [] END::INTEGER[] AS months FROM v)
        SELECT p_partkey, coalesce(array_to_string(won, ','), '') AS amounts,
            coalesce(array_to_string(months, ','), '') AS periods,
            won[1] AS first_amount, months[1] AS first_period FROM l""",
    "extract_amounts": """SELECT p_partkey, CAST(p_size AS BIGINT) * 10000 AS amount_won,
        CAST((p_size % 7 + 1) * 12 AS INTEGER) AS period_months FROM part""",
    "final_answer": f"""SELECT conv_id, turn, CASE
        WHEN grounded IS NULL THEN '{S.NO_RESULTS_MESSAGE}'
        WHEN grounded = 1 THEN text WHEN turn % 2 = 1 THEN 'base'
        ELSE '{S.GENERATION_ERROR_MESSAGE}' END AS answer
        FROM ({_GROUND.format(join='LEFT JOIN')})""",
    "response_rows": f"""WITH r AS (SELECT l_orderkey, count(*) AS n,
            arg_min(p_name, rank) AS p_name
            FROM ({_RANKED}) JOIN part ON l_partkey = p_partkey GROUP BY 1)
        SELECT o_orderkey AS query_id,
            CASE WHEN o_orderstatus = 'P' THEN 'error' ELSE 'success' END AS status,
            CASE WHEN o_orderstatus = 'P' THEN '{S.SYSTEM_ERROR_MESSAGE}' ELSE o_orderpriority END
                AS recommendation,
            CASE WHEN o_orderstatus = 'F' THEN 'JSON' END AS error,
            c_nationkey::BIGINT AS conversation_turns,
            CASE o_orderstatus WHEN 'F' THEN 'information' WHEN 'O' THEN 'comparison'
                ELSE 'recommendation' END AS intent,
            n AS n_results, p_name AS first_product
        FROM orders LEFT JOIN r ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey""",
    "job_collect": """SELECT 'D' AS prdt_div, l_orderkey AS fin_prdt_cd, l_linenumber AS save_trm,
        o_orderpriority AS kor_co_nm,
        CASE WHEN o_orderkey IS NULL THEN CAST(l_shipdate::DATE AS VARCHAR) END AS dcls_month,
        CAST(o_orderdate::DATE AS VARCHAR) AS dcls_month_x,
        CASE WHEN o_orderkey IS NOT NULL THEN CAST(l_shipdate::DATE AS VARCHAR) END AS dcls_month_y
        FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus <> 'P'""",
    "job_collect_counts": """SELECT 'D' AS prdt_div, count(*) AS records,
        count(DISTINCT l_orderkey) AS reported FROM lineitem""",
    "collect_tables": f"""SELECT o_orderstatus AS prdt_div, '{REGION}' AS region_code,
        count(*) AS records, count(DISTINCT o_orderkey) AS reported
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
    "preprocess_all": """SELECT product_type, p_brand AS kor_co_nm, p_name AS fin_prdt_nm, first_key,
            'ok' AS status, count(*) OVER (PARTITION BY product_type) AS rows
        FROM (SELECT ['deposit', 'saving', 'annuity', 'mortgage', 'rent', 'credit'][p_partkey % 6 + 1]
            AS product_type, p_brand, p_name, min(p_partkey) AS first_key FROM part GROUP BY ALL)""",
    "job_preprocess": """SELECT p_partkey, p_brand, p_name, concat_ws(chr(10),
            concat('name: ', p_name), concat('company: ', p_brand),
            concat('rate: ', printf('%.2f', p_retailprice), '%')) AS search_text
        FROM part WHERE p_type <> 'ECONOMY'
        QUALIFY row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_partkey) = 1""",
    "job_recommend": f"""WITH p AS (SELECT vec_id, embedding::DOUBLE[] AS v, label,
            {TYPES}[label % 6 + 1] AS ptype, coalesce(p_name, '') AS name, coalesce(p_brand, '') AS brand
            FROM embeddings LEFT JOIN part ON p_partkey = vec_id),
        t AS (SELECT q.vec_id AS query_id, q.label AS ql, p.vec_id, p.ptype, p.name, p.brand,
            list_dot_product(q.v, p.v) AS d, ['deposit', 'saving', ''][q.label % 3 + 1] AS target
            FROM p, p q),
        r AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY d DESC, vec_id) <= 3),
        h AS (SELECT *, max((ptype = target)::INT) OVER (PARTITION BY query_id) AS hit FROM r),
        k AS (SELECT *, row_number() OVER (PARTITION BY query_id
            ORDER BY round(round(d, 6), 3) DESC, vec_id) AS rank FROM h WHERE hit = 0 OR ptype = target),
        a AS (SELECT vec_id AS query_id,
            CASE WHEN label % 2 = 0 THEN concat('pick ', name) ELSE 'nothing' END AS generated,
            CASE WHEN label % 4 = 1 THEN 'base' ELSE '' END AS fallback FROM p),
        g AS (SELECT a.query_id, max(contains(generated, name)::INT)
            FILTER (name <> '' AND brand <> '') AS grounded,
            count(*) AS n_results, string_agg(name, '|' ORDER BY rank) AS names
            FROM a JOIN k ON a.query_id = k.query_id GROUP BY 1),
        c AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1)
        SELECT a.query_id, 'success' AS status, CASE WHEN grounded IS NULL THEN '{S.NO_RESULTS_MESSAGE}'
            WHEN grounded = 1 THEN generated WHEN fallback <> '' THEN fallback
            ELSE '{S.GENERATION_ERROR_MESSAGE}' END AS recommendation,
            floor(least(coalesce(n, 0) + 2, 20) / 2)::BIGINT AS conversation_turns, n_results, names
        FROM a JOIN g ON a.query_id = g.query_id LEFT JOIN c ON c.conv_id = a.query_id""",
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: batch recommend over the sf0.001 tables."""
    return q_job_recommend(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """
    the optional subpackage."""
    out = dict(QUERIES)
    if llm_queries is not None:
        out |= llm_queries.QUERIES
        out["pipeline"] = corpus_pipeline.run
    return out


def oracle_sql() -> dict[str, str]:
    """SQL equivalents, where SQL can say the same."""
    out = dict(ORACLE)
    out.update({k: ORACLE[v] for k, v in ORACLE_ALIASES.items()})
    if llm_queries is not None:
        out |= llm_queries.ORACLE
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
