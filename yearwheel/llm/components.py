"""Connected components of a table of links, by alternating large and small stars.

Each round hangs every vertex under smaller ones (large star: greater neighbours under the smallest
known; small star: smaller neighbours under the smallest), as joins and aggregations of links that are
written to the shared folder, until a round changes nothing. The number of rounds grows with the
logarithm of the number of vertices, and links never outnumber those given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearwheel.operators.staging import Staging


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def connected(links: DataFrame, stage: Staging, name: str = "links") -> DataFrame:
    """``vertex`` and ``root``, the smallest vertex it reaches, for each vertex of a link (a, b).

    Vertices without a link to another are not in the result.
    """
    clean = links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    now, k = stage(clean.distinct(), f"{name}-0"), 0
    last = _fingerprint(now)
    while last[0]:
        k += 1
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), f"{name}-{k}-least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = stage(large.distinct(), f"{name}-{k}-large")
        top = stage(large.groupBy("hi").agg(F.min("lo").alias("m")), f"{name}-{k}-top")
        small = large.join(top, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = stage(small.union(top.select("hi", "m")).distinct(), f"{name}-{k}")
        found = _fingerprint(now)
        if found == last:
            break
        last = found
    roots = now.select(F.col("lo").alias("vertex"), F.col("lo").alias("root")).distinct()
    return now.select(F.col("hi").alias("vertex"), F.col("lo").alias("root")).union(roots)
