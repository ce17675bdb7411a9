"""Joins of trips with their detail tables and concordances.

The fact joins are plain equi-joins on the trip key. A trip that owns a large share of the detail
rows is split by adaptive execution; small concordances are broadcast by Spark when their size
allows it. Semi and anti joins reduce the other side to its distinct keys first, so one frequent
key never meets the join as more than one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRIP = "TripIDNumber"
DETAIL_TRIP = "TripID"


def with_details(trips: DataFrame, details: DataFrame) -> DataFrame:
    """One row per trip and detail row; trip columns, weights included, repeat on each."""
    return trips.join(details, trips[TRIP] == details[DETAIL_TRIP]).drop(DETAIL_TRIP)


def with_purpose_group(trips: DataFrame, purposes: DataFrame) -> DataFrame:
    """Add POV_Group. Trips whose purpose is not in the concordance are dropped."""
    return trips.join(purposes, "POV")


def with_activity_group(activities: DataFrame, classification: DataFrame) -> DataFrame:
    """Add Activity_Group. Activities that are not classified are dropped."""
    matched = activities.join(classification, activities["Activities"] == classification["Activity"])
    return matched.select(DETAIL_TRIP, "Activity_Group", "Activities")


def trips_with(trips: DataFrame, details: DataFrame) -> DataFrame:
    """Trips that own at least one detail row, each once."""
    owners = details.select(F.col(DETAIL_TRIP).alias(TRIP)).distinct()
    return trips.join(owners, TRIP, "left_semi")


def unused_values(reference: DataFrame, used: DataFrame, key: str) -> DataFrame:
    """Rows of ``reference`` whose key never occurs in ``used``."""
    return reference.join(used.select(key).distinct(), key, "left_anti")


def unmatched(rows: DataFrame, known: DataFrame, key: str, amounts: Sequence[str]) -> DataFrame:
    """Values of ``key`` in ``rows`` that ``known`` lacks, with the totals of ``amounts`` they carry."""
    totals = rows.groupBy(key).agg(*[F.sum(a).alias(a) for a in amounts])
    lost = totals.join(known.select(F.col(key).alias("_known")).distinct(), F.col(key).eqNullSafe(F.col("_known")), "left_anti")
    return lost.select(F.lit(key).alias("dimension"), F.col(key).cast("string").alias("member"), *amounts)
