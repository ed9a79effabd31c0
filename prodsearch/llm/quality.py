"""Quality rules by line-first cleaning, in DataFrame functions only.

Every line is tested by punctuation, navigation and boilerplate rules, the
failing lines are removed, and a document that loses too large a share of
its words is rejected. One pass over each text, no shuffle.

Defined cases: a null, empty or blank text has no words and is rejected; a
null in another column passes through; repeated rows are judged alike; an
empty table gives an empty table; extra columns are kept (columns this
module adds are named by ``prefix``, so clashing names can be avoided).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodsearch.llm.common import SPACES, let, word_array

MIN_WORDS = 20              # fewer words: rejected
MAX_REPEAT_PCT = 30         # more words in repeated 8-word windows: rejected
MAX_LOST_PCT = 50           # more words lost with failing lines: rejected
MAX_MARK_PCT = 25           # marks per 100 words of a line: symbol runs, shouting, separators
WINDOW = 8

SYMBOLS = "#*$%&|<>"
# A line must end a sentence somewhere: a mark followed by closing marks and a space or the end.
SENTENCE = r"[.!?…。][\"')\]»”]*([\x20\x09-\x0D]|\z)"
SYMBOL_RUN = r"[#*$%&<>=_~^]{2,}"
SHOUT = r"[!?]{2,}"
SEPARATORS = "|»›•·"
NAVIGATION = (r"(?i)(^|[^a-z])(home|menu|site ?map|log ?in|log ?out|sign ?in|sign ?up|next page|"
              r"previous page|back to top|skip to content|read more|share this)([^a-z]|\z)")
NAVIGATION_WORDS = 6        # navigation words count in lines this short only
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "uses cookies", "accept cookies", "enable javascript", "subscribe to our newsletter",
    "click here", "lorem ipsum", "powered by", "licensed under")


def _words(line: Column) -> Column:
    return F.size(word_array(line))


def punctuation_fails(line: Column, words: Column) -> Column:
    """No sentence ends in the line, or symbol runs or repeated ! and ? stand
    after more than MAX_MARK_PCT of its words."""
    marks = F.regexp_count(line, F.lit(SYMBOL_RUN)) + F.regexp_count(line, F.lit(SHOUT))
    return ~line.rlike(SENTENCE) | (100 * marks > MAX_MARK_PCT * words)


def navigation_fails(line: Column, words: Column) -> Column:
    """Menu separators for more than MAX_MARK_PCT of the words, or a short
    line with a navigation word."""
    seps = F.length(line) - F.length(F.translate(line, SEPARATORS, ""))
    return (100 * seps > MAX_MARK_PCT * words) | (
        (words <= NAVIGATION_WORDS) & line.rlike(NAVIGATION))


def boilerplate_fails(line: Column) -> Column:
    """A known boilerplate phrase."""
    return let(F.lower(line), lambda low: reduce(
        lambda a, b: a | b, [F.contains(low, F.lit(p)) for p in BOILERPLATE]))


def line_fails(line: Column, words: Column) -> Column:
    return punctuation_fails(line, words) | navigation_fails(line, words) | boilerplate_fails(line)


def lost_in(line: Column) -> Column:
    """The words lost with a line: all of them if it fails, else none."""
    return let(_words(line), lambda n: F.when(line_fails(line, n), n).otherwise(0))


def repeat_words(words: Column) -> Column:
    """Words inside 8-word windows whose content occurs twice or more in the
    text, the first occurrence included.

    Windows are compared by a 64-bit hash built by doubling (pairs, fours,
    eights); a collision needs about 2^32 windows in one text. Texts without
    a repeated window, the usual case, stop after one distinct count.
    """
    def doubled(h: Column, step: int) -> Column:
        return let(h, lambda x: let(F.greatest(F.size(x) - step, F.lit(0)), lambda n: F.zip_with(
            F.slice(x, 1, n), F.slice(x, step + 1, n), lambda a, b: F.xxhash64(a, b))))

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            return F.sort_array(F.filter(F.transform(s, lambda x, j: F.when(
                (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]), x["i"])),
                lambda i: i.isNotNull()))

        def total(at: Column) -> Column:
            return F.aggregate(
                at, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
                lambda acc, i: F.struct(
                    (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"),
                    i.alias("last")),
                lambda acc: acc["n"])
        return let(placed, lambda s: let(repeated(s), total))

    def of_words(w: Column) -> Column:
        eights = doubled(doubled(doubled(F.transform(w, lambda x: F.xxhash64(x)), 1), 2), 4)
        return let(eights, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0))
                   .otherwise(covered(h)))

    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(of_words(words)).cast("long")


def measure(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """Add the rules' columns: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, lost_words, kept_text and kept."""
    t = F.coalesce(F.col(text), F.lit(""))
    name = lambda c: prefix + c
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = let(word_array(t), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), repeat_words(w).alias("r")))
    line_facts = let(lines, lambda ls: F.struct(
        (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("dup"),
        F.aggregate(ls, F.lit(0).cast("long"), lambda a, x: a + lost_in(x)).alias("lost")))
    kept_lines = F.filter(F.split(t, "\n"), lambda x: lost_in(x) == 0)
    df = docs.withColumns({
        name("_w"): out,
        name("_l"): line_facts,
        name("word_chars"): F.length(F.regexp_replace(t, SPACES, "")).cast("long"),
        name("n_symbols"): (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        name("kept_text"): F.array_join(kept_lines, "\n"),
    })
    n, r, lost = (F.col(name("_w"))["n"], F.col(name("_w"))["r"], F.col(name("_l"))["lost"])
    failed = (n < MIN_WORDS) | (100 * r > MAX_REPEAT_PCT * n)
    return df.withColumns({
        name("n_words"): n,
        name("n_dup_lines"): F.col(name("_l"))["dup"],
        name("n_repeat_words"): r,
        name("base_failed"): failed,
        name("lost_words"): lost,
        name("kept"): ~failed & (100 * lost <= MAX_LOST_PCT * n),
    }).drop(name("_w"), name("_l"))


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents the rules keep, without their failing lines; the columns of
    ``docs`` only (``n_chars``, where there is one, follows the new text)."""
    p = "__q_"
    kept = measure(docs, text, p).where(F.col(p + "kept"))
    out = {text: F.col(p + "kept_text")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.length(F.col(p + "kept_text")).cast(docs.schema["n_chars"].dataType)
    return kept.withColumns(out).select(*docs.columns)
