"""The operators bound to the driver's tables, and their SQL where SQL can
say the same. Each query runs its operator over the whole table and derives
the result's columns from the operator's output."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prodsearch.llm import (
    brown_lm,
    cutting_stock,
    embed_dedup,
    html_text,
    langid,
    mixing,
    ngram_join,
    packing,
    periodic_runs,
    prefix_trie,
    quality,
    secret_scan,
    token_count,
)


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def op1_mixing(spark: SparkSession, d: str) -> DataFrame:
    m = mixing.mix(_docs(spark, d))
    return m.select("doc_id", F.col("__mix_size").alias("size"),
                    F.col("__mix_source_size").alias("source_size"),
                    F.col("__mix_target").alias("target"),
                    (F.col("__mix_size") * F.col("__mix_copies")).alias("taken"))


def op2_quality(spark: SparkSession, d: str) -> DataFrame:
    q = quality.measure(_docs(spark, d).select("doc_id", "text"))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed", "lost_words", "kept")


def op3_embedding_dedup(spark: SparkSession, d: str) -> DataFrame:
    return embed_dedup.near_duplicates(spark.read.parquet(f"{d}/embeddings.parquet"))


def op4_secrets(spark: SparkSession, d: str) -> DataFrame:
    s = secret_scan.scan(_docs(spark, d))
    return s.select("doc_id", "n_assign", "n_access", "n_hex",
                    F.sha2("base", 256).alias("base_sha256"), "spans")


def op5_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join.cluster(_docs(spark, d)).select("doc_id", "n_shingles", "component_id")


def op6_lm_scoring(spark: SparkSession, d: str) -> DataFrame:
    return brown_lm.train_and_score(_docs(spark, d))


def op7_language_id(spark: SparkSession, d: str) -> DataFrame:
    return langid.identify(_docs(spark, d))


def op8_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_count.count_tokens(_docs(spark, d), public_tokenizers.path(BPE))


def op9_html_text(spark: SparkSession, d: str) -> DataFrame:
    return html_text.main_text(spark.read.parquet(f"{d}/pages.parquet"))


def op10_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(_docs(spark, d), public_tokenizers.path(BPE))


def op11_cutting_stock(spark: SparkSession, d: str) -> DataFrame:
    return cutting_stock.pack(_docs(spark, d), public_tokenizers.path(BPE))


def runs_digest(runs: DataFrame) -> DataFrame:
    """The digest columns of ``periodic_runs``' rows."""
    r = F.col("runs")
    # greatest length, then smallest start, then smallest period
    best = F.array_max(F.transform(r, lambda x: F.struct(
        x["length"].alias("n"), (-x["start"]).alias("s"), (-x["period"]).alias("q"))))
    lines = F.array_join(F.transform(r, lambda x: F.concat_ws(
        ",", x["start"], x["length"], x["period"])), "\n")
    listed = F.when(F.size(r) > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return runs.select("doc_id", "runs", "collapsed", best.alias("b")).select(
        "doc_id", F.size(r).cast("long").alias("n_runs"), (-F.col("b.s")).alias("start"),
        F.col("b.n").alias("length"), (-F.col("b.q")).alias("period"),
        F.floor(F.expr("1000 * b.n div -b.q")).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(_docs(spark, d).select("doc_id", "text"))
    return runs_digest(periodic_runs.periodic_runs(docs))


def op13_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    turns = prefix_trie.conversation_turns(spark.read.parquet(f"{d}/conversations.parquet"))
    return prefix_trie.trie_nodes(prefix_trie.with_borrowed_heads(turns))


BPE = "byte_bpe_50k.json"
WORD = r"[^\x20\x09-\x0D]+"


def _words(text: str) -> str:
    return f"regexp_extract_all({text}, '{WORD}')"


def mixing_ctes(docs: str = "documents") -> str:
    """CTEs ending in ``mixed`` (a row per document with ``copies``)."""
    weights = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mixing.WEIGHTS))
    m = mixing.MAX_EPOCHS
    return f"""sized AS (SELECT d.*, len({_words("coalesce(text, '')")})::BIGINT AS size,
            ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h
            FROM {docs} d),
        by_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
        ranked AS (SELECT *, (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1)
            % {len(mixing.WEIGHTS)} {weights} END)::BIGINT AS weight FROM by_source),
        running AS (SELECT *, (sum(source_size) OVER ())::BIGINT AS total,
            coalesce(sum({m} * source_size) OVER before, 0)::BIGINT AS used,
            (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS weights_left
            FROM ranked WINDOW before AS (ORDER BY source_size / weight,
                coalesce('s' || source, 'n') ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        marked AS (SELECT *, (total - used)::DOUBLE * weight
            >= ({m} * source_size)::DOUBLE * weights_left AS stops FROM running),
        shared AS (SELECT *, max(weights_left) FILTER (NOT stops) OVER () AS wl,
            max(total - used) FILTER (NOT stops) OVER () AS left_over FROM marked),
        targets AS (SELECT source, source_size, CASE WHEN stops THEN ({m} * source_size)::DOUBLE
            ELSE left_over::DOUBLE * weight / wl END AS target FROM shared),
        needs AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT
            ELSE 0 END AS epochs FROM targets),
        placed AS (SELECT s.*, n.source_size, n.target, n.epochs,
            n.target - n.epochs * n.source_size AS need,
            sum(size) OVER (PARTITION BY s.source ORDER BY h) AS hi,
            sum(size) OVER (PARTITION BY s.source, h) AS own
            FROM sized s JOIN needs n ON s.source IS NOT DISTINCT FROM n.source),
        mixed AS (SELECT *, epochs + CASE WHEN size = 0 THEN 0 WHEN hi <= need THEN 1
            WHEN hi - own <= need AND hi - need < need - (hi - own) THEN 1 ELSE 0 END AS copies
            FROM placed)"""


OP1_SQL = f"""WITH {mixing_ctes()}
    SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken FROM mixed"""


def _line_fails(line: str) -> str:
    n = f"len({_words(line)})"
    marks = "+".join(f"len(regexp_extract_all({line}, '{p}'))" for p in (quality.SYMBOL_RUN, quality.SHOUT))
    seps = f"(length({line}) - length(translate({line}, '{quality.SEPARATORS}', '')))"
    sentence = quality.SENTENCE.replace("'", "''")
    return f"""(NOT regexp_matches({line}, '{sentence}')
        OR 100 * ({marks}) > {quality.MAX_MARK_PCT} * {n}
        OR 100 * {seps} > {quality.MAX_MARK_PCT} * {n}
        OR (regexp_matches({line}, '{quality.NAVIGATION}') AND {n} <= {quality.NAVIGATION_WORDS})
        OR {" OR ".join(f"contains(lower({line}), '{p}')" for p in quality.BOILERPLATE)})"""


def quality_ctes(docs: str = "documents") -> str:
    """CTEs ending in ``judged``: each document (by row number rid) with the
    rules' columns and the cleaned text."""
    return f"""src AS (SELECT *, row_number() OVER () AS rid, coalesce(text, '') AS t FROM {docs}),
        facts AS (SELECT *, {_words("t")} AS w,
            list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM src),
        grams AS (SELECT rid, i, array_to_string(w[i:i + {quality.WINDOW - 1}], ' ') AS g
            FROM (SELECT rid, w, unnest(range(1, len(w) - {quality.WINDOW - 2})) AS i FROM facts)),
        twice AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM grams),
        cover AS (SELECT rid, count(DISTINCT p)::BIGINT AS r FROM (SELECT rid,
            unnest(range(i, i + {quality.WINDOW})) AS p FROM twice WHERE c > 1) GROUP BY rid),
        sums AS (SELECT f.*, len(w)::BIGINT AS n_words, coalesce(r, 0)::BIGINT AS n_repeat_words,
            length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
            (length(t) - length(translate(t, '{quality.SYMBOLS}', '')))::BIGINT AS n_symbols,
            (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
            coalesce(list_sum(list_transform(list_filter(ls, lambda x: {_line_fails("x")}),
                lambda x: len({_words("x")}))), 0)::BIGINT AS lost_words
            FROM facts f LEFT JOIN cover c ON f.rid = c.rid),
        tested AS (SELECT *, n_words < {quality.MIN_WORDS}
            OR 100 * n_repeat_words > {quality.MAX_REPEAT_PCT} * n_words AS base_failed FROM sums),
        judged AS (SELECT *, NOT base_failed
            AND 100 * lost_words <= {quality.MAX_LOST_PCT} * n_words AS kept,
            array_to_string(list_filter(string_split(t, chr(10)), lambda x:
                NOT regexp_matches(x, '{WORD}') OR NOT {_line_fails("x")}), chr(10)) AS kept_text
            FROM tested)"""


OP2_SQL = f"""WITH {quality_ctes()}
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        lost_words, kept FROM judged"""

_REACH = """reach(a, b) AS (SELECT a, b FROM links UNION
            SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        least_of AS (SELECT a, min(b) AS low FROM reach GROUP BY a)"""

OP3_SQL = f"""WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
        n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v),
        links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM n x JOIN n y ON x.vec_id <> y.vec_id
            AND x.norm > 0 AND y.norm > 0
            AND list_dot_product(x.e, y.e) / (x.norm * y.norm) >= {embed_dedup.COSINE}),
        {_REACH},
        degree AS (SELECT a, count(*) AS d FROM links GROUP BY a)
    SELECT vec_id, coalesce(d, 0)::BIGINT AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
        vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
    FROM v LEFT JOIN least_of ON vec_id = least_of.a LEFT JOIN degree ON vec_id = degree.a"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_N = ngram_join.GRAM_WORDS

OP5_SQL = f"""WITH RECURSIVE w AS (SELECT doc_id, {_words(_LOWER)} AS w FROM documents),
        grams AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {_N}
            THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - {_N - 2}),
            lambda i: array_to_string(w[i:i + {_N - 1}], ' ')) END) AS g FROM w),
        sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1),
        same AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS s FROM grams x
            JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM same JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id
            WHERE 100 * s >= {ngram_join.THRESHOLD} * (p.n + q.n - s)),
        {_REACH}
    SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles,
        least(w.doc_id, coalesce(low, w.doc_id)) AS component_id
    FROM w LEFT JOIN sizes ON w.doc_id = sizes.doc_id LEFT JOIN least_of ON w.doc_id = a"""

# crc32 of a string of digits, bit by bit
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
            string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: [ord(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
            lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))))"""

OP13_SQL = f"""WITH own AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
            ORDER BY turn NULLS FIRST, role, text) AS w FROM conversations
            WHERE conv_id IS NOT NULL GROUP BY conv_id),
        hashed AS (SELECT *, {_CRC} % 9 AS h FROM own),
        rebuilt AS (SELECT a.conv_id, list_concat(coalesce(b.w[1:a.h], []), a.w[a.h + 1:]) AS w
            FROM hashed a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5),
        members AS (SELECT conv_id, len(w) AS n, unnest(range(0, len(w) + 1)) AS d, w FROM rebuilt),
        keyed AS (SELECT conv_id, d, n, md5(w[1:d]::JSON::VARCHAR) AS k, strlen(w[d].t) AS b FROM members),
        nodes AS (SELECT k, d, min(conv_id) AS low, count(*)::BIGINT AS n_convs, any_value(b) AS b,
            string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d) AS ended
            FROM keyed GROUP BY k, d),
        up AS (SELECT DISTINCT c.k, p.k AS pk FROM keyed c JOIN keyed p
            ON c.conv_id = p.conv_id AND p.d = c.d - 1),
        kids AS (SELECT pk AS k, count(*)::BIGINT AS n_children FROM up GROUP BY pk),
        under AS (SELECT DISTINCT p.k AS top, c.k AS k FROM keyed p JOIN keyed c
            ON c.conv_id = p.conv_id AND c.d >= p.d),
        sums AS (SELECT top, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_leaves,
            sum(CASE WHEN d > 0 THEN (n_convs - 1) * b ELSE 0 END)::BIGINT AS saved_tokens
            FROM under JOIN nodes USING (k) LEFT JOIN kids USING (k) GROUP BY top)
    SELECT n.low AS conv_id, n.d AS depth, p.low AS parent_conv_id, n.n_convs,
        coalesce(n_children, 0)::BIGINT AS n_children, n_leaves, saved_tokens,
        sha256(coalesce(n.ended, '')) AS ends_sha256
    FROM nodes n LEFT JOIN up ON n.k = up.k LEFT JOIN nodes p ON up.pk = p.k
        LEFT JOIN kids ON n.k = kids.k JOIN sums ON n.k = sums.top"""

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_quality": op2_quality,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_secrets": op4_secrets,
    "op5_ngram_join": op5_ngram_join,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_language_id": op7_language_id,
    "op8_token_counts": op8_token_counts,
    "op9_html_text": op9_html_text,
    "op10_packing": op10_packing,
    "op11_cutting_stock": op11_cutting_stock,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE = {
    "op1_mixing": OP1_SQL,
    "op2_quality": OP2_SQL,
    "op3_embedding_dedup": OP3_SQL,
    "op5_ngram_join": OP5_SQL,
    "op13_prefix_trie": OP13_SQL,
}
