"""Operator 1: mix sources to target weights, by Efraimidis-Spirakis sampling. DataFrame functions only.

Every document draws an exponential key from its id, divided by its quality weight; sorted by it, a source
is a weighted sample without replacement, and a prefix of it that fills a budget is the mix. Complete epochs
come first: a target of 2.3 times the source takes every document twice and a prefix of 0.3 of the words.

No source is sorted as a whole. Its keys fall into bins of about ``BIN_ROWS`` documents; sums per bin tell
which bin the budget ends in, and only that bin is sorted. So a source with a third of all rows makes no
task longer than a bin.

Defined cases: null text has size 0; null source is a source of its own, last in order; null id draws the key of the
empty text; ties of keys go by size, then by id; documents of size 0 are never taken; repeated rows count
each; an empty table gives an empty result; other columns are left aside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import written

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Documents in a bin of keys, on average.
BIN_ROWS = 4_000
#: Weights of documents by label: good, bad; all others weigh 1.
GOOD, BAD = 2.0, 0.5


def word_count(text):
    """Number of words ``[^\\x20\\x09-\\x0D]+``, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def quality_weights(labels: DataFrame) -> DataFrame:
    """One weight per labelled document; of contradicting labels the better one holds."""
    best = labels.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return best.select("doc_id", F.when(F.col("quality") > 0, GOOD).otherwise(BAD).alias("weight"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, n_docs) to targets in words, by filling up to the caps.

    All sources share the sum of all sizes by weight; one that would get more than ``max_epochs`` times its
    size stops there. Sorted by cap per weight, the sources that stop are a prefix. One row per source
    is sorted here, however many documents there are.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("place", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("w", weight).withColumn("cap", F.col("source_size") * max_epochs)
    up = Window.orderBy(F.col("cap") / F.col("w"), "place").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.orderBy(F.col("cap") / F.col("w"), "place").rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(up), F.lit(0))) / F.sum("w").over(down)
    filled = ranked.withColumn("level", level).withColumn("open", F.col("level") * F.col("w") < F.col("cap"))
    # the first source that does not stop sets the level of all after it
    final = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("w"), "place", "level"))).over(every)["level"]
    capped = F.col("cap").cast("double")
    return filled.withColumn("final", final).select(
        "source",
        "source_size",
        "n_docs",
        F.when(F.col("final").isNull(), capped).otherwise(F.least(capped, F.col("final") * F.col("w"))).alias("target"),
    )


def mix(docs: DataFrame, doc_weights: DataFrame | None = None, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(doc_id, source, text) to (doc_id, source, size, source_size, target, taken).

    ``doc_weights`` (doc_id, weight > 0) has at most one row per document. A document is in the fractional part
    if the middle of its words lies within the budget, so a source misses its target by half a document at most.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    if doc_weights is None:
        sized = sized.withColumn("weight", F.lit(1.0))
    else:
        sized = sized.join(doc_weights.select("doc_id", "weight"), "doc_id", "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
    digest = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 12)
    uniform = (F.conv(digest, 16, 10).cast("double") + 0.5) / F.lit(float(2**48))
    keyed = written(sized.withColumn("key", -F.log(uniform) / F.col("weight")), "mix")

    totals = keyed.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    targets = written(source_targets(totals, weights, max_epochs), "mix-targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = (
        targets.withColumn("epochs", epochs)
        .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
        .withColumn("bins", F.ceil(F.col("n_docs") / BIN_ROWS).cast("long"))
        .withColumnRenamed("source", "its_source")
    )
    placed = keyed.join(targets, F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source")
    # 1 - exp(-key) is even between 0 and 1 for weight 1 and keeps the order of the keys
    placed = placed.withColumn("bin", F.least(F.floor((1 - F.exp(-F.col("key"))) * F.col("bins")), F.col("bins") - 1))

    bins = placed.groupBy("source", "bin").agg(F.sum("size").alias("in_bin"))
    before = F.sum("in_bin").over(Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    bins = bins.select(F.col("source").alias("bin_source"), F.col("bin").alias("bin_no"), "in_bin", F.coalesce(before, F.lit(0)).alias("before"))
    located = placed.join(bins, F.col("source").eqNullSafe(F.col("bin_source")) & (F.col("bin") == F.col("bin_no")))

    kept = ["doc_id", "source", "size", "source_size", "target", "epochs"]
    whole = F.col("before") + F.col("in_bin") <= F.col("budget")
    outside = F.col("before") >= F.col("budget")
    easy = located.filter(whole | outside).select(*kept, F.when(whole, 1).otherwise(0).alias("extra"))
    order = Window.partitionBy("source", "bin").orderBy("key", "size", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    up_to = F.col("before") + F.sum("size").over(order)
    cut = located.filter(~(whole | outside)).withColumn("up_to", up_to)
    cut = cut.select(*kept, F.when(F.col("up_to") - F.col("size") / 2 < F.col("budget"), 1).otherwise(0).alias("extra"))
    mixed = easy.unionByName(cut)
    taken = F.least(F.col("epochs") + F.col("extra"), F.lit(max_epochs)) * F.col("size")
    return mixed.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))
