"""Language identification: averaged hashed subword embeddings with a linear
softmax, trained by stochastic gradient descent in numpy.

Subwords are character n-grams inside words, word ends marked; the hashes of
one to four characters pick rows of an embedding table, and a text is the
mean of its rows. The classifier is fitted on a bounded sample of labelled
documents (TRAIN_DOCS, shared evenly by the languages; of more than
MAX_LANGUAGES label values, as mistyped ones may be, the most frequent are
learned, and documents of others are predicted among them); a part of it that is
held back calibrates the probabilities by a temperature and sets the level
below which a prediction counts as rejected. Every whole text is predicted,
batch by batch where it is read.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
a null language is not learned from; without any label everything is
``und``; repeated rows are predicted alike; an empty table gives an empty
table; other columns are not read.
"""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prodsearch.llm.common import map_texts, mix64

TRAIN_DOCS = 2_400          # bound of the sample the classifier is fitted on
MAX_LANGUAGES = 400         # label values learned, the most frequent ones
BUCKETS = 1 << 12
DIM = 16
ORDERS = (1, 2, 3, 4)
EPOCHS, BATCH, RATE = 30, 32, 100.0
HELD_BACK = 0.2             # share of the sample kept for calibration
REJECT_SHARE = 0.01         # share of right predictions the rejection level gives up
UNKNOWN = "und"

_SPACE = np.uint32(32)
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((unicodedata.category(chr(i))[0] == "L"
                                     for i in range(sys.maxunicode + 1)), bool))
    return _LETTERS[0]


def subword_counts(text: str | None) -> np.ndarray | None:
    """How often each bucket occurs in the whole text; None without a letter."""
    if not text:
        return None
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[cp]
    if not is_letter.any():
        return None
    # words of letters, with one space at either end of each
    cp = np.r_[_SPACE, np.where(is_letter, cp, _SPACE), _SPACE]
    cp = cp[np.r_[True, (cp[1:] != _SPACE) | (cp[:-1] != _SPACE)]].astype(np.uint64)
    space = cp == 32
    counts = np.zeros(BUCKETS)
    h = np.zeros(len(cp), np.uint64)
    inner = np.zeros(len(cp), bool)      # a space inside, not at an end
    with np.errstate(over="ignore"):
        for n in range(1, max(ORDERS) + 1):
            m = len(cp) - n + 1
            if m <= 0:
                break
            inner = inner[:m] | (space[n - 2:n - 2 + m] if n > 2 else False)
            h = h[:m] * np.uint64(0x100000001B3) + cp[n - 1:n - 1 + m] + np.uint64(n)
            if n in ORDERS:
                ok = ~inner & ~space[:m] if n == 1 else ~inner
                at = (mix64(h[ok]) >> np.uint64(52)).astype(np.int64)
                counts += np.bincount(at, minlength=BUCKETS)
    return counts


@dataclass
class Model:
    languages: list[str]
    embedding: np.ndarray       # BUCKETS x DIM
    weights: np.ndarray         # DIM x languages
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def logits(self, means: np.ndarray) -> np.ndarray:
        return (means @ self.embedding) @ self.weights + self.bias

    def probabilities(self, means: np.ndarray) -> np.ndarray:
        return softmax(self.logits(means) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def means_of(counts: list[np.ndarray]) -> np.ndarray:
    x = np.stack(counts).astype(np.float32)
    return x / x.sum(axis=1, keepdims=True)


def fit(means: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> Model:
    """Stochastic gradient descent on the log loss, then calibration."""
    rng = np.random.default_rng(seed)
    k = len(languages)
    order = rng.permutation(len(labels))
    back = order[:int(len(order) * HELD_BACK)] if len(order) >= 10 * k else order[:0]
    train = order[len(back):]
    m = Model(languages, rng.normal(0, 1 / DIM, (BUCKETS, DIM)).astype(np.float32),
              np.zeros((DIM, k), np.float32), np.zeros(k, np.float32))
    steps, step = EPOCHS * -(-len(train) // BATCH), 0
    for _ in range(EPOCHS):
        rng.shuffle(train)
        for s in range(0, len(train), BATCH):
            rows = train[s:s + BATCH]
            x = means[rows]
            hidden = x @ m.embedding
            grad = softmax(hidden @ m.weights + m.bias)
            grad[np.arange(len(rows)), labels[rows]] -= 1
            grad /= len(rows)
            rate = np.float32(RATE * (1 - step / steps))
            to_rows = x.T @ (grad @ m.weights.T)
            m.weights -= np.float32(0.05) * rate * (hidden.T @ grad)
            m.bias -= np.float32(0.001) * rate * grad.sum(axis=0)
            m.embedding -= rate * to_rows
            step += 1
    check = back if len(back) else train
    z, y = m.logits(means[check]), labels[check]
    loss = {t: -np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean()
            for t in np.geomspace(0.25, 8, 51)}
    m.temperature = float(min(loss, key=loss.get))
    p = softmax(z / m.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == y]
    m.reject_below = float(np.quantile(right, REJECT_SHARE)) if len(right) else 0.0
    return m


def held_out(doc_id: Column, folds: int = 3) -> Column:
    """Documents never learned from: crc32 of the id as text mod folds is 1."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 1


def training_sample(docs: DataFrame, doc_id: str, text: str, lang: str,
                    train_docs: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, subword means, label numbers) of the bounded sample: for
    each language the documents with the smallest hashes of their ids."""
    t, i = F.col(f"`{text}`"), F.col(f"`{doc_id}`")
    usable = docs.where(F.col(f"`{lang}`").isNotNull() & ~held_out(i) & t.rlike(r"\p{L}"))
    by_lang = usable.select(F.col(f"`{lang}`").alias("lang"), i.alias("id"), F.xxhash64(t).alias("th"))
    often = by_lang.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(MAX_LANGUAGES)
    known = sorted(r[0] for r in often.collect())
    if not known:
        return [], np.empty((0, BUCKETS), np.float32), np.empty(0, int)
    by_lang = by_lang.where(F.col("lang").isin(known))
    each = max(1, train_docs // len(known))
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", "th")
    chosen = (by_lang.withColumn("rn", F.row_number().over(by_hash)).where(F.col("rn") <= each)
              .select("lang", "id", "th").distinct())
    rows = (usable.select(F.col(f"`{lang}`").alias("l"), i.alias("d"), F.xxhash64(t).alias("h"), t.alias("text"))
            .join(F.broadcast(chosen), (F.col("l") == F.col("lang")) & F.col("d").eqNullSafe(F.col("id"))
                  & (F.col("h") == F.col("th")))
            .dropDuplicates(["lang", "id", "th"]).select("lang", "id", "text"))

    def make():
        def of(texts: list) -> dict:
            out = {"bucket": [], "count": []}
            for x in texts:
                c = subword_counts(x)
                c = np.zeros(BUCKETS) if c is None else c
                at = np.flatnonzero(c)
                out["bucket"].append(at)
                out["count"].append(c[at].astype(np.int64))
            return out
        return of

    # at most train_docs rows of BUCKETS numbers reach the driver
    got = sorted(map_texts(rows, ["lang", "id"], "text", make,
                           {"bucket": "array<long>", "count": "array<long>"}).collect(),
                 key=lambda r: (r.lang, str(r.id)))
    counts = []
    for r in got:
        c = np.zeros(BUCKETS)
        c[r["bucket"]] = r["count"]
        counts.append(c)
    keep = [k for k, c in enumerate(counts) if c.any()]
    place = {v: k for k, v in enumerate(known)}
    if not keep:
        return [], np.empty((0, BUCKETS), np.float32), np.empty(0, int)
    return known, means_of([counts[k] for k in keep]), np.array([place[got[k].lang] for k in keep])


def predict(docs: DataFrame, model: Model | None, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` plus lang_pred, score (the calibrated probability) and
    rejected (a score below the calibrated level, or ``und``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)     # a few hundred kB

    def make():
        m = shared.value

        def of(texts: list) -> dict:
            out = {"lang_pred": [], "score": [], "rejected": []}
            for s in range(0, len(texts), 64):
                counts = [subword_counts(t) for t in texts[s:s + 64]]
                known = [c for c in counts if c is not None] if m else []
                p = iter(m.probabilities(means_of(known))) if known else iter(())
                for c in counts:
                    best = next(p) if m and c is not None else None
                    score = 0.0 if best is None else min(1.0, float(best.max()))
                    out["lang_pred"].append(UNKNOWN if best is None else m.languages[int(best.argmax())])
                    out["score"].append(score)
                    out["rejected"].append(best is None or score < m.reject_below)
            return out
        return of

    return map_texts(docs, keep, text, make,
                     {"lang_pred": "string", "score": "double", "rejected": "boolean"})


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected per row of ``docs``,
    learning from the rows that are not held out."""
    languages, means, labels = training_sample(docs, doc_id, text, lang, train_docs)
    model = fit(means, labels, languages) if languages else None
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), held_out(F.col(f"`{doc_id}`")).alias("held_out"),
                       F.col(f"`{text}`").alias("text"))
    return predict(rows, model, ["doc_id", "held_out"], "text")
