"""Session settings the extracts are designed for."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution is what splits a hot trip in the fact joins and turns a small shuffled
# side into a broadcast; ANSI mode is what turns a malformed number into an error. All are Spark
# defaults, stated here so that a site profile which switches them off is overridden on purpose.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# Shuffled bytes one task should meet. Adaptive execution merges partitions that stay smaller but
# does not add any, so the starting number has to fit the largest shuffle.
PARTITION_BYTES = 256 * 2**20


def shuffle_partitions(shuffled_bytes: int) -> int:
    """Starting number of shuffle partitions for a largest shuffle of this size."""
    return max(200, -(-shuffled_bytes // PARTITION_BYTES))


def shuffled_bytes(table: DataFrame) -> int:
    """Spark's estimate of a table's bytes, of the columns it has been narrowed to.

    For files it comes from their sizes, so it costs no job. A fact table narrowed to the columns of an
    extract stands for what its join shuffles; totals and sums by trip are smaller.
    """
    return int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def sized_for(spark: SparkSession, tables: Iterable[DataFrame]) -> int:
    """Set the session's shuffle partitions for the largest of the tables; returns the number."""
    number = shuffle_partitions(max(map(shuffled_bytes, tables)))
    spark.conf.set("spark.sql.shuffle.partitions", number)
    return number


def configured(builder: SparkSession.Builder, fact_bytes: int | None = None) -> SparkSession.Builder:
    """Apply :data:`SETTINGS`, and with ``fact_bytes`` a number of shuffle partitions to match."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if fact_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions(fact_bytes))
    return builder
