"""Conversation tables: bounded history, overflow policy, marked messages,
appending turns and question context (W1-W6, F14, A10).

Messages are rows ``(conv_id, turn, role, text)``; order is the ``turn``
column, never the physical row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import text as TX


def last_n(messages: DataFrame, n: int, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """The last n messages of every conversation.

    ``row_number <= n`` over the conversation gets a partial WindowGroupLimit
    before the shuffle, so a long (or hot) conversation ships at most n rows
    per map task.
    """
    w = Window.partitionBy(conv).orderBy(F.col(turn).desc())
    return messages.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n).drop("__r")


def overflow_trim(messages: DataFrame, max_messages: int = 2 * S.MAX_CONVERSATION_TURNS,
                  keep_ratio: float = S.OVERFLOW_KEEP_RATIO, policy: str = "auto",
                  conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Apply the overflow policy to conversations with >= max_messages.

    auto: keep the last int(max_messages * keep_ratio); reset: drop them;
    manual: keep everything. Shorter conversations are untouched.
    The conversation size is a hash aggregate joined back, and rows are
    first limited per conversation, so no window holds a whole conversation.
    """
    if policy == "manual":
        return messages
    sizes = messages.groupBy(conv).agg(F.count(F.lit(1)).alias("__cnt"))
    if policy == "reset":
        small = sizes.where(F.col("__cnt") < max_messages).select(conv)
        return messages.join(small, conv, "left_semi")
    if policy != "auto":
        raise ValueError(f"unknown overflow policy {policy!r}")
    keep = int(max_messages * keep_ratio)
    bound = max(keep, max_messages - 1)
    w = Window.partitionBy(conv).orderBy(F.col(turn).desc())
    limited = messages.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= bound)
    return (limited.join(sizes, conv, "inner")
            .where((F.col("__cnt") < max_messages) | (F.col("__r") <= keep))
            .drop("__r", "__cnt"))


def overflow_counts(messages: DataFrame, max_messages: int = 2 * S.MAX_CONVERSATION_TURNS,
                    keep_ratio: float = S.OVERFLOW_KEEP_RATIO, policy: str = "auto",
                    conv: str = "conv_id") -> DataFrame:
    """Kept and dropped message counts per conversation under the policy."""
    n = F.col("n")
    keep = int(max_messages * keep_ratio)
    kept = {"auto": F.when(n >= max_messages, F.least(n, F.lit(keep))).otherwise(n),
            "reset": F.when(n >= max_messages, F.lit(0)).otherwise(n),
            "manual": n}[policy]
    return (messages.groupBy(conv).agg(F.count(F.lit(1)).alias("n"))
            .select(conv, kept.cast("long").alias("kept"), (n - kept).cast("long").alias("dropped")))


def newest_where(messages: DataFrame, cond: Column, value: str = "text",
                 conv: str = "conv_id", turn: str = "turn", oldest: bool = False,
                 out: str | None = None) -> DataFrame:
    """Per conversation, the newest (or oldest) message value meeting cond.

    The turn is found by a hash aggregate of numbers and the message by a
    join back on it, so texts are not sorted. Of messages that repeat a turn
    the greatest value counts."""
    hits = messages.where(cond)
    last = hits.groupBy(conv).agg((F.min(turn) if oldest else F.max(turn)).alias(turn))
    found = hits.select(conv, turn, value).join(last, [conv, turn], "left_semi")
    first = Window.partitionBy(conv).orderBy(F.col(value).desc())
    return (found.withColumn("__r", F.row_number().over(first)).where("__r = 1")
            .select(conv, F.col(value).alias(out or value)))


def is_assistant(role: str = "role") -> Column:
    """Any role other than user counts as the assistant (roles normalised)."""
    return F.col(role) != "user"


def last_recommended(messages: DataFrame, product_marker: str = S.PRODUCT_MARKER,
                     company_marker: str = S.COMPANY_MARKER, allow_bold: bool = True,
                     text: str = "text", role: str = "role", conv: str = "conv_id",
                     turn: str = "turn") -> DataFrame:
    """Newest assistant message holding both markers, with the value after
    each marker on its first marked line: ``(conv, text, product, company)``."""
    pre = TX.marker_regex(product_marker, allow_bold)
    cre = TX.marker_regex(company_marker, allow_bold)
    cond = is_assistant(role) & TX.has_marker(text, pre) & TX.has_marker(text, cre)
    msg = newest_where(messages, cond, text, conv, turn)
    return msg.withColumns({"product": TX.marker_value(text, pre),
                            "company": TX.marker_value(text, cre)})


def context_note(messages: DataFrame, marker_re: str, window: int = S.CONTEXT_WINDOW,
                 chars: int = S.CONTEXT_NOTE_CHARS, prefix: str = S.CONTEXT_NOTE_PREFIX,
                 oldest: bool = False, text: str = "text", role: str = "role",
                 conv: str = "conv_id", turn: str = "turn", out: str = "note") -> DataFrame:
    """Among each conversation's last ``window`` messages, the newest (or,
    with ``oldest``, the first) assistant message with the marker, cut to
    ``chars`` characters plus ``...`` behind the prefix."""
    recent = last_n(messages, window, conv, turn)
    cond = is_assistant(role) & TX.has_marker(text, marker_re)
    picked = newest_where(recent, cond, text, conv, turn, oldest=oldest, out="__t")
    return picked.select(conv, F.concat(F.lit(prefix), TX.cut("__t", chars)).alias(out))


def append_turns(history: DataFrame, new_turns: DataFrame, question: str = "question",
                 answer: str = "answer", conv: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """Append one user and one assistant message per conversation after its
    last turn (turn = max + 1, max + 2); a new conversation starts at 0."""
    last = history.groupBy(conv).agg(F.max(turn).alias("__t"))
    nt = new_turns.join(last, conv, "left").withColumn("__t", F.coalesce("__t", F.lit(-1)))
    user = nt.select(conv, (F.col("__t") + 1).cast("long").alias(turn), F.lit("user").alias(role),
                     F.col(question).alias(text))
    bot = nt.select(conv, (F.col("__t") + 2).cast("long").alias(turn),
                    F.lit("assistant").alias(role), F.col(answer).alias(text))
    return history.select(conv, turn, role, text).unionByName(user).unionByName(bot)


def with_context(questions: DataFrame, context: DataFrame, product: str = "product",
                 conv: str = "conv_id", text: str = "text", out: str = "question",
                 lead: str = "이전 추천 상품: ", ask: str = "질문: ",
                 company: str = "company") -> DataFrame:
    """Prefix each question with its conversation's last recommended
    product and its company, when there is one (one context row per
    conversation)."""
    known = F.col(company) if company in context.columns else F.lit(None).cast("string")
    q = questions.join(context.select(conv, F.col(product).alias("__p"), known.alias("__c")), conv, "left")
    firm = F.coalesce(F.concat(F.lit(" ("), F.col("__c"), F.lit(")")), F.lit(""))
    made = F.concat(F.lit(lead), F.col("__p"), firm, F.lit("\n"), F.lit(ask), F.col(text))
    return (q.withColumn(out, F.when(F.col("__p").isNull(), F.col(text)).otherwise(made))
            .drop("__p", "__c"))


def contextual_question(messages: DataFrame, context: DataFrame, product: str = "product",
                        conv: str = "conv_id", role: str = "role", text: str = "text",
                        out: str = "question",
                        lead: str = "이전 추천 상품: ", ask: str = "질문: ") -> DataFrame:
    """User questions, prefixed with the conversation's last recommended
    product when there is one."""
    return with_context(messages.where(F.col(role) == "user"), context, product, conv, text,
                        out, lead, ask)
