"""Mix sources to target weights by Poisson replication.

A source's mean repetition rate is what its target weight asks of its size. Each document draws its
number of copies from the Poisson distribution of that mean by inverting it at a uniform number that a
hash of seed and doc_id gives, so the draw is the same in every run and needs no state. Copies are
exploded and dealt out by a hash of their own, which shuffles all sources globally and evenly.

Defined cases: a null source is a source; a null doc_id draws by its text; rows with the same doc_id
draw the same number of copies; columns of the input named like those added are replaced; a source without any characters counts as one character; an empty
table stays empty. Copies of one document, however long it is, come from one task, row by row; the shuffle spreads them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearwheel.operators.staging import Staging

SLOTS = 256


def source_sizes(docs: DataFrame) -> DataFrame:
    """Characters of each source."""
    chars = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    return docs.groupBy("source").agg(F.greatest(F.sum(chars), F.lit(1)).cast("double").alias("size"))


def tempered_weights(sizes: DataFrame, power: float) -> DataFrame:
    """Weight of each source: its size to a power below 1 raises small sources, 0 makes all equal."""
    return sizes.withColumn("weight", F.pow("size", F.lit(power)))


def repetition_rates(weighted: DataFrame, scale: float = 1.0) -> DataFrame:
    """Mean number of copies by source, so that sizes after mixing stand as the weights do.

    The mixture is ``scale`` times as large as all sources together.
    """
    size, weight = weighted.agg(F.sum("size"), F.sum("weight")).first()
    rate = F.lit(scale * (size or 0.0)) * F.col("weight") / F.lit(weight or 1.0) / F.col("size")
    return weighted.withColumn("rate", rate)


def poisson_steps(rates: DataFrame) -> DataFrame:
    """One row for each rate and number of copies k that a document can draw: ``rate``, ``k``, ``low``, ``high``.

    A uniform number in (low, high] draws k. Rows reach as far as a double can tell the distribution from 1. Their
    probabilities come from one running sum of logarithms and one of themselves, each linear in the rate.
    """
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 40).cast("int")
    counts = F.when(F.col("rate") > 0, F.sequence(F.lit(0), last)).otherwise(F.array(F.lit(0)))
    steps = rates.select("rate").distinct().withColumn("k", F.explode(counts))
    so_far = Window.partitionBy("rate").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    log_p = F.sum(F.when(F.col("k") == 0, -F.col("rate")).otherwise(F.log(F.col("rate") / F.col("k")))).over(so_far)
    top = F.sum(F.exp("log_p")).over(so_far)
    high = steps.withColumn("log_p", log_p).withColumn("high", F.when(F.col("rate") > 0, top).otherwise(1.0))
    by_k = Window.partitionBy("rate").orderBy("k")
    # the ends lie outside [0, 1), so that every number meets one row
    low = F.lag("high").over(by_k)
    end = F.when(F.lead("k").over(by_k).isNull(), 2.0).otherwise(F.col("high"))
    return high.select("rate", "k", F.coalesce(low, F.lit(-1.0)).alias("low"), end.alias("high")).where("high > low")


def _slot(u: Column) -> Column:
    """Which of SLOTS equal parts of [0, 1) a number is in."""
    return F.least(F.greatest(F.floor(u * SLOTS), F.lit(0)), F.lit(SLOTS - 1)).cast("int")


def uniform(seed: str) -> Column:
    """Number in [0, 1) from a hash of seed and document: 52 bits of an md5."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.coalesce("text", F.lit(""))))
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 13), 16, 10).cast("long")
    return bits / F.lit(float(1 << 52))


def replicate(docs: DataFrame, rates: DataFrame, stage: Staging, seed: str = "mix") -> DataFrame:
    """Documents times their copies: all columns, with rate, n_copies, copy and shuffle_key.

    A document meets only the few numbers of copies in its source's slot of [0, 1), whatever the rate; the slots also
    split a source that holds most documents, should the list of steps be too large to broadcast.
    """
    steps = poisson_steps(rates).withColumn("__slot", F.explode(F.sequence(_slot(F.col("low")), _slot(F.col("high")))))
    # a table of its own, so that Spark knows how large it is when it plans the join
    listed = rates.select(F.col("source").alias("__source"), "rate").join(steps, "rate")
    tables = stage(listed.select("__source", "__slot", "rate", F.col("k").alias("n_copies"), "low", "high"), "steps")
    numbered = docs.drop("rate", "n_copies", "copy", "shuffle_key").withColumn("__u", uniform(seed))
    met = numbered["source"].eqNullSafe(tables["__source"]) & (_slot(numbered["__u"]) == tables["__slot"])
    drawn = numbered.join(tables, met & (numbered["__u"] > tables["low"]) & (numbered["__u"] <= tables["high"]))
    drawn = drawn.select(*[numbered[c] for c in numbered.columns if c != "__u"], tables["rate"], "n_copies")
    copies = drawn.where("n_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.coalesce("text", F.lit(""))))
    keyed = copies.withColumn("shuffle_key", F.md5(F.concat(F.lit(f"{seed}:order:"), name, F.lit(":"), F.col("copy"))))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def mix(docs: DataFrame, stage: Staging, power: float = 0.5, scale: float = 1.0, seed: str = "mix") -> DataFrame:
    """Mix the sources of ``docs`` to weights of their sizes to ``power``."""
    sizes = stage(source_sizes(docs), "sizes")
    return replicate(docs, repetition_rates(tempered_weights(sizes, power), scale), stage, seed)
