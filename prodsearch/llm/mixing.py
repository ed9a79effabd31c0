"""Mixing sources to target weights, in DataFrame functions only.

Each document gets a fixed hash. Sizes are summed by source and hash bucket,
a running sum finds the bucket in which a source's budget runs out, and only
that bucket is split again by the next hash bits, until it holds a single
document. A source then takes whole epochs of itself plus the documents whose
hash lies below its threshold: a filter, no sort of documents. Thresholds of
growing budgets are nested, as all use the same hash.

Defined cases: null and empty texts have size 0 and are taken 0 words; a null
source is a source of its own, after all others; a null id hashes like an
empty one; rows with one id share a hash and are taken together; a source
without words has target 0; an empty table gives an empty table; extra
columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prodsearch.llm.common import SPACES
from prodsearch.operators.guard import broadcast_if_small
from prodsearch.session import cut_lineage

WEIGHTS = (5, 2, 1)         # by rank of the source, repeating
MAX_EPOCHS = 3              # a target stops at this many times its source's size
HASH_BITS = 60
LEVEL_BITS = 12             # buckets per refinement: 4096, so 5 levels use the whole hash
MAX_BROADCAST_SOURCES = 20_000


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), SPACES),
                           lambda w: w != "")).cast("long")


def document_hash(doc_id: Column) -> Column:
    """60 bits of the id's MD5 as a long, the same on every engine."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(skey, source, source_size) -> with ``target`` and whole ``epochs``.

    The total is shared by weight; a source stops at max_epochs times its
    size and what it can't use is shared again by weight. In the order of
    size per weight the stopped sources come first, so running sums find
    them without repeated rounds. One row per source goes through this.
    """
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                     ((F.row_number().over(rank) - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("weight", w.cast("long"))
    stop = (F.col("source_size") / F.col("weight")).asc()
    before = Window.orderBy(stop, F.col("skey")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    zero = F.lit(0).cast("long")
    shared = ranked.withColumns({
        "total": F.sum("source_size").over(whole),
        "used": F.coalesce(F.sum(max_epochs * F.col("source_size")).over(before), zero),
        "weights_left": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), zero),
    })
    left_over = (F.col("total") - F.col("used")).cast("double") * F.col("weight")
    stops = left_over >= (max_epochs * F.col("source_size")).cast("double") * F.col("weights_left")
    # those after the last stopped source share what is left
    marked = shared.withColumn("stops", stops)
    left = F.max(F.when(~F.col("stops"), F.struct("weights_left", "used"))).over(whole)
    share = (F.col("total") - left["used"]).cast("double") * F.col("weight") / left["weights_left"]
    target = F.when(F.col("stops"), (max_epochs * F.col("source_size")).cast("double")).otherwise(share)
    out = marked.withColumn("target", target)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    return out.withColumn("epochs", F.coalesce(epochs, zero)).select(
        "skey", "source", "source_size", "target", "epochs")


def _boundary(rows: DataFrame, shift: int) -> DataFrame:
    """Per source, the bucket in which its budget ``need`` runs out: the
    words before it, its own words and its number of documents. Sources
    whose budget covers all their rows have none."""
    hist = (rows.groupBy("skey", "need", "base", F.shiftright("h", shift).alias("bucket"))
            .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs"),
                 F.min("h").alias("h_min"), F.max("h").alias("h_max")))
    run = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cum = hist.withColumn("lo", F.col("base") + F.coalesce(F.sum("words").over(run), F.lit(0)))
    return (cum.where((F.col("lo") <= F.col("need")) & (F.col("lo") + F.col("words") > F.col("need")))
            .select("skey", "need", F.col("lo").alias("base"), "words", "docs", "bucket",
                    "h_min", "h_max"))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(skey, cut): documents of the source with hash <= cut are taken once
    more than ``epochs`` times. The document at the boundary is taken where
    that brings the source nearer its target."""
    need = F.col("target") - F.col("epochs") * F.col("source_size")
    want = targets.select("skey", need.alias("need"))
    rows = (sized.where("size > 0").join(broadcast_if_small(want, MAX_BROADCAST_SOURCES), "skey")
            .withColumn("base", F.lit(0).cast("long")))
    found = None
    shift = HASH_BITS
    while shift > 0:
        shift -= LEVEL_BITS
        edge = cut_lineage(_boundary(rows, shift))
        # a bucket of one hash can't be split further
        done = edge if shift == 0 else edge.where("h_min = h_max")
        found = done if found is None else found.unionByName(done)
        if shift == 0 or edge.where("h_min < h_max").isEmpty():
            break
        narrowed = edge.where("h_min < h_max").select("skey", "base", F.col("bucket").alias("at"))
        rows = (rows.drop("base").join(broadcast_if_small(narrowed, MAX_BROADCAST_SOURCES), "skey")
                .where(F.shiftright("h", shift) == F.col("at")).drop("at"))
    over = F.col("base") + F.col("words") - F.col("need")
    under = F.col("need") - F.col("base")
    return found.select("skey", F.when(over < under, F.col("h_min"))
                        .otherwise(F.col("h_min") - 1).alias("cut"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add __mix_size, __mix_source_size, __mix_target and __mix_copies (how
    often the mix takes the document) to ``docs``."""
    key = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n"))
    facts = {"skey": key, "size": word_count(F.col(text)), "h": document_hash(F.col(doc_id))}
    sized = cut_lineage(docs.select(F.col(source).alias("source"), *[c.alias(n) for n, c in facts.items()]))
    sizes = sized.groupBy("skey", "source").agg(F.sum("size").alias("source_size"))
    targets = cut_lineage(source_targets(sizes, weights, max_epochs))
    cuts = thresholds(sized, targets)
    plan = targets.join(cuts, "skey", "left").select(
        F.col("skey").alias("__mix_skey"), F.col("source_size").alias("__mix_source_size"),
        F.col("target").alias("__mix_target"), F.col("epochs").alias("__mix_epochs"),
        # no boundary: a whole number of epochs, or nothing to take
        F.coalesce("cut", F.lit(-1)).alias("__mix_cut"))
    plan = cut_lineage(plan)
    out = (docs.withColumns({"__mix_skey": key, "__mix_size": facts["size"], "__mix_h": facts["h"]})
           .join(broadcast_if_small(plan, MAX_BROADCAST_SOURCES), "__mix_skey"))
    extra = (F.col("__mix_h") <= F.col("__mix_cut")).cast("long")
    return (out.withColumn("__mix_copies", F.col("__mix_epochs") + extra)
            .drop("__mix_skey", "__mix_h", "__mix_epochs", "__mix_cut"))


def mixed_documents(docs: DataFrame, **kw) -> DataFrame:
    """The mix itself: each document as often as it is taken (0 to max_epochs
    times), with the columns of ``docs``."""
    m = mix(docs, **kw).where("__mix_copies > 0")
    return (m.withColumn("__mix_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__mix_copies"))))
            .select(*docs.columns))
