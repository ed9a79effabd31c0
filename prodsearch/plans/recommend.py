"""Batch recommend job (X3): a table of questions against a table of
products, producing ranked results, prompts, checked answers and response
rows. Many questions and conversations are processed in one job."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import text as TX
from ..operators import clean, dialog, joins, retrieve
from ..session import cut_lineage
from ..sources import files


def parse_json_or_error(df: DataFrame, raw: str, schema: T.StructType, out: str,
                        corrupt: str = "_corrupt") -> DataFrame:
    """``from_json`` that keeps bad input: ``out`` is the parsed struct (null
    when the text is not a JSON object of that shape) and ``out_bad`` says
    whether parsing failed."""
    full = T.StructType(list(schema.fields) + [T.StructField(corrupt, T.StringType())])
    parsed = F.from_json(F.col(raw), full,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    bad = (parsed[corrupt].isNotNull() | parsed.isNull()) & F.col(raw).isNotNull()
    ok = F.struct(*[parsed[f.name].alias(f.name) for f in schema.fields])
    return df.withColumns({out: F.when(~bad, ok), f"{out}_bad": bad})


def answer_cascade(grounded: Column, generated: Column, fallback: Column) -> Column:
    """No candidates -> fixed message; grounded -> the generated answer;
    otherwise the fallback answer, or the error message when there is none."""
    return (F.when(grounded.isNull(), F.lit(S.NO_RESULTS_MESSAGE))
            .when(grounded == 1, generated)
            .otherwise(F.coalesce(F.nullif(fallback, F.lit("")),
                                  F.lit(S.GENERATION_ERROR_MESSAGE))))


def product_documents(processed: DataFrame, type_col: str = "product_type") -> DataFrame:
    """Processed products of all types (one table, e.g. read back from
    ``files.write_processed``) as search documents: a stable id, type,
    company, name, search text and the row packed as ``raw_data`` (columns
    another type owns, null here, are left out)."""
    data_cols = [c for c in processed.columns if c != type_col]
    packed = clean.pack_raw(processed, data_cols, "raw_data")
    raw = F.map_filter("raw_data", lambda _k, v: v.isNotNull())
    pid = F.xxhash64(F.col(type_col), F.col(S.COMPANY_COL), F.col(S.PRODUCT_COL))
    return packed.select(pid.alias("product_id"), F.col(type_col).alias("product_type"),
                         F.col(S.COMPANY_COL).alias("company"),
                         F.col(S.PRODUCT_COL).alias("product_name"), "search_text",
                         raw.alias("raw_data"))


def analysis_from_json(df: DataFrame, raw: str, out: str = "analysis") -> DataFrame:
    """Parse the analysis JSON. Unparsable text becomes an error value
    ``{error, raw_response (first 50 chars + ...), status}``; it is data,
    not a failure, and it carries no intent (so the route is information)."""
    p = parse_json_or_error(df, raw, S.ANALYSIS_SCHEMA, out)
    err = F.struct(F.lit("JSON 파싱 실패").alias("error"),
                   TX.cut(F.col(raw), S.RAW_RESPONSE_CHARS).alias("raw_response"),
                   F.lit("json_parse_error").alias("status"))
    return p.withColumn(f"{out}_error", F.when(F.col(f"{out}_bad"), err)).drop(f"{out}_bad")


def analysis_from_keywords(df: DataFrame, text: str, out: str = "analysis") -> DataFrame:
    """Keyword analysis of a question table: category and intent from the
    fixed taxonomies, amount and period by regex."""
    a = F.struct(
        TX.classify_by_keywords(text, S.CATEGORY_TAXONOMY, lower=False).alias("product_category"),
        F.nullif(TX.classify_by_keywords(text, S.INTENT_TAXONOMY, lower=False), F.lit(""))
        .alias("user_intent"),
        TX.amount_won(text).cast("string").alias("amount_mentioned"),
        TX.period_months(text).cast("string").alias("period_mentioned"))
    return df.withColumn(out, a)


def search(products: DataFrame, queries: DataFrame, k: int = S.RETRIEVE_K, *,
           compat_rules: bool = False) -> DataFrame:
    """Top-k, category filter with fallback, ranked and validated results.

    products: (product_id, product_type, company, product_name, raw_data,
    embedding); queries: (query_id, embedding, analysis struct).
    """
    attrs = [c for c in ("product_type", "company", "product_name", "raw_data")
             if c in products.columns]
    top = retrieve.vector_topk(products, queries, k, product_id="product_id",
                               query_id="query_id", payload=attrs)
    target = TX.category_to_type(F.coalesce(F.col("analysis.product_category"), F.lit("")),
                                 TX.category_rules(compat_rules))
    tq = queries.select("query_id", target.alias("target_type"))
    r = top.join(tq, "query_id")
    r = retrieve.category_fallback(r, "query_id", "product_type", "target_type", out_hit="hit")
    r = retrieve.rank_results(r, ["query_id"], "score", "product_id", out="rank",
                              digits=S.SCORE_DIGITS)
    r = clean.fill_defaults(r, {"product_name": S.UNKNOWN_TEXT, "company": S.UNKNOWN_TEXT,
                                "product_type": S.OTHER_TYPE})
    valid = (TX.is_filled("product_name") & TX.is_filled("company") & TX.is_filled("product_type"))
    return r.withColumn("valid", valid)


def prompts(results: DataFrame, queries: DataFrame, notes: DataFrame | None = None,
            text: str = "text") -> DataFrame:
    """One prompt per query, in the form its route asks for (wording ours):
    information and recommendation use the best valid result, comparison
    the first three as ``- name (company)`` lines."""
    v = results.where("valid")
    if "raw_data" in v.columns:  # maps are not orderable: carry them as JSON text
        v = v.withColumn("raw_json", F.to_json("raw_data"))
    else:
        v = v.withColumn("raw_json", F.lit("{}"))
    # the first three of a query, once: the best one's columns and all three as lines
    place = Window.partitionBy("query_id").orderBy(F.col("rank").asc(), F.col("product_id").asc())
    top = v.withColumn("__r", F.row_number().over(place)).where("__r <= 3")
    line = F.concat(F.lit("- "), F.col("product_name"), F.lit(" ("), F.col("company"), F.lit(")"))
    lines = F.sort_array(F.collect_list(F.struct("__r", line.alias("l"))))["l"]
    best = top.groupBy("query_id").agg(
        F.min(F.struct("__r", "product_name", "company", "product_type", "score", "raw_json")).alias("b"),
        F.array_join(lines, "\n").alias("lines")).select("query_id", "b.*", "lines").drop("__r")
    q = queries.select("query_id", "conv_id", text, F.col("analysis.user_intent").alias("intent"))
    q = q.join(best, "query_id")
    if notes is not None:
        q = q.join(notes.select("conv_id", "note"), "conv_id", "left")
    else:
        q = q.withColumn("note", F.lit(None).cast("string"))
    q = q.withColumn("route", TX.route_intent("intent", text))
    info = TX.template(["사용자 질문: ", ("col", text), "\n", ("col", "note"), "\n상품명: ",
                        ("col", "product_name"), "\n금융회사: ", ("col", "company"),
                        "\n상품 유형: ", ("col", "product_type"), "\n상세 정보: ",
                        ("col", "raw_json")])
    cmp_ = TX.template(["사용자 질문: ", ("col", text), "\n", ("col", "note"),
                        "\n비교 대상 상품들:\n", ("col", "lines")])
    rec = TX.template([("col", "note"), "\n사용자 질문: ", ("col", text), "\n상품명: ",
                       ("col", "product_name"), "\n금융회사: ", ("col", "company"),
                       "\n유사도: ", ("col", "score"), "\n상세 정보: ", ("col", "raw_json")])
    prompt = (F.when(F.col("route") == "information", info)
              .when(F.col("route") == "comparison", cmp_).otherwise(rec))
    return q.select("query_id", "conv_id", "route", prompt.alias("prompt"))


def final_answers(results: DataFrame, answers: DataFrame) -> DataFrame:
    """Answer cascade per query: no valid result -> fixed message; a
    generated answer naming any valid product -> it; else the fallback
    answer; else the error message. answers: (query_id, generated,
    fallback)."""
    names = results.where("valid").select("query_id", F.col("product_name").alias("name"))
    g = joins.grounding(answers, names, "query_id", "query_id", "generated", "name")
    out = answer_cascade(F.col("grounded"), F.col("generated"), F.col("fallback"))
    return g.withColumn("recommendation", out)


def response_rows(final: DataFrame, results: DataFrame, queries: DataFrame,
                  history_turns: DataFrame | None = None) -> DataFrame:
    """Success rows carry the answer, the analysis (its error value where
    the analysis text was unparsable, which stops nothing), all results and
    the turn count; a question whose answer failed gives an error row."""
    res = (results.groupBy("query_id")
           .agg(F.sort_array(F.collect_list(F.struct("rank", "product_name", "company",
                                                     "product_type", "score", "valid")))
                .alias("search_results")))
    if "analysis_error" not in queries.columns:
        queries = queries.withColumn("analysis_error", F.lit(None).cast(
            "struct<error:string,raw_response:string,status:string>"))
    q = queries.select("query_id", "conv_id", "analysis", "analysis_error")
    r = final.select("query_id", "recommendation").join(q, "query_id", "right").join(
        res, "query_id", "left")
    if history_turns is not None:
        r = r.join(history_turns, "conv_id", "left")
    else:
        r = r.withColumn("turns", F.lit(None).cast("long"))
    failed = F.col("recommendation").isNull()
    return r.select("query_id", F.when(failed, "error").otherwise("success").alias("status"),
                    F.coalesce("recommendation", F.lit(S.SYSTEM_ERROR_MESSAGE)).alias("recommendation"),
                    F.col("analysis_error.error").alias("error"), "analysis", "analysis_error",
                    "search_results", F.col("turns").alias("conversation_turns"))


def recommend(products: DataFrame, queries: DataFrame, messages: DataFrame | None = None,
              answers: DataFrame | None = None, k: int = S.RETRIEVE_K,
              materialize: bool = True) -> dict[str, DataFrame]:
    """The whole job. queries need (query_id, conv_id, text, embedding) and
    either ``analysis`` or nothing (then keywords decide).

    The questions and the ranked results feed every output (prompts,
    answers, responses), so by default both are checkpointed once into the
    shared checkpoint folder: the product scan runs once, and a lost
    executor re-reads the checkpoint instead of recomputing the scan.
    """
    if "analysis" not in queries.columns:
        queries = analysis_from_keywords(queries, "text")
    if materialize:
        # the question table (with its embeddings) feeds search, prompts and
        # responses; one checkpoint instead of re-running its upstream plan
        queries = cut_lineage(queries)
    results = search(products, queries, k)
    if materialize:
        results = cut_lineage(results)
    notes = None
    asked = queries
    if messages is not None:
        m = clean.normalize_roles(messages)
        notes = dialog.context_note(m, TX.marker_regex(S.PRODUCT_MARKER))
        # questions carry the conversation's last recommended product
        asked = dialog.with_context(queries, dialog.last_recommended(m), out="text")
    out = {"results": results, "prompts": prompts(results, asked, notes)}
    if answers is not None:
        out["final"] = final_answers(results, answers)
        turns = None
        if messages is not None:
            turns = dialog.append_turns(
                messages, out["final"].join(queries.select("query_id", "conv_id", "text"),
                                            "query_id")
                .select("conv_id", F.col("text").alias("question"),
                        F.col("recommendation").alias("answer")))
            turns = dialog.last_n(turns, S.HISTORY_CAP)
            out["history"] = turns
            turns = turns.groupBy("conv_id").agg(
                F.floor(F.count(F.lit(1)) / 2).cast("long").alias("turns"))
        out["responses"] = response_rows(out["final"], results, queries, turns)
    return out


def index_products(spark, processed_root: str, dim: int = 256):
    """(encoder, products): the processed types found under
    ``<root>/product_type=<type>`` as documents with embeddings of their
    search texts; the encoder is fitted on them."""
    frames = {}
    for t in S.CORE_COLUMNS:
        try:
            frames[t] = spark.read.parquet(f"{processed_root}/product_type={t}")
        except AnalysisException:       # a type without a file
            continue
    documents = product_documents(files.union_typed(frames))
    return retrieve.fit_embed(documents, "search_text", dim)


def answer(model, products: DataFrame, questions: DataFrame, messages: DataFrame | None = None,
           answers: DataFrame | None = None, k: int = S.RETRIEVE_K) -> dict[str, DataFrame]:
    """Questions (query_id, conv_id, text) embedded with the products' encoder
    and put through ``recommend``."""
    return recommend(products, retrieve.embed(model, questions, "text"), messages, answers, k)


def first_after_fallback(results: DataFrame) -> DataFrame:
    """The first kept result per query (its k rows at most)."""
    w = Window.partitionBy("query_id").orderBy(F.col("rank").asc())
    return results.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


__all__ = ["analysis_from_json", "analysis_from_keywords", "search", "prompts",
           "final_answers", "response_rows", "recommend", "index_products", "answer",
           "first_after_fallback", "Column"]
