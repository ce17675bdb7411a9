"""Cleaning of the row-level tables before they are joined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearwheel.functions.banding import length_of_stay_band
from yearwheel.functions.recode import (
    ACCOMMODATION_RULES,
    ACTIVITY_CLASS_RULES,
    ACTIVITY_RULES,
    DESTINATION_RULES,
    NO_PURPOSE,
    PURPOSE_RULES,
    SPEND_TYPE_RULES,
    recode,
)

WEIGHTS = [
    "RespondentWeight",
    "SmoothedTripWeight",
    "ExpenditureWeight",
    "ImputedSpendAccom",
    "ImputedSpendTrnsport",
]
DAY = "Day Trip"
OVERNIGHT = "Overnight Trip"


def clean_trips(trips: DataFrame) -> DataFrame:
    """Missing weights and amounts become 0, a missing purpose ``None``; then the recodes.

    Works on whichever of the columns are present, so a pruned table stays pruned.
    """
    present = set(trips.columns)
    out = trips.fillna(0, [w for w in WEIGHTS if w in present])
    if "DestinationRTO" in present:
        out = out.withColumn("DestinationRTO", recode(F.col("DestinationRTO"), DESTINATION_RULES))
    if "POV" in present:
        out = out.fillna(NO_PURPOSE, ["POV"]).withColumn("POV", recode(F.col("POV"), PURPOSE_RULES))
    return out


def overnight_trips(trips: DataFrame) -> DataFrame:
    return trips.where(F.col("TripType") == OVERNIGHT)


def clean_stays(stays: DataFrame) -> DataFrame:
    """Missing nights become 0; adds the length-of-stay band."""
    return (
        stays.select("TripID", "AccommodationType", "NoNights")
        .fillna(0, ["NoNights"])
        .withColumn("AccommodationType", recode(F.col("AccommodationType"), ACCOMMODATION_RULES))
        .withColumn("LOS_Group", length_of_stay_band(F.col("NoNights")))
    )


def clean_spend(spend: DataFrame) -> DataFrame:
    """Rows without a trip are dropped."""
    return (
        spend.select("TripID", "SpendType", "ImputedSpendAmt")
        .where(F.col("TripID").isNotNull())
        .withColumn("SpendType", recode(F.col("SpendType"), SPEND_TYPE_RULES))
    )


def clean_activities(activities: DataFrame) -> DataFrame:
    """Recode; a missing activity is an error, raised by the task that meets it.

    Other categories become dimensions and are audited there, but a missing activity would leave
    unseen with the inner join to its group.
    """
    missing = F.raise_error(F.lit("missing value in Activities")).cast("string")
    return activities.drop("AnswerNumber", "LegNumber").withColumn(
        "Activities", F.coalesce(recode(F.col("Activities"), ACTIVITY_RULES), missing)
    )


def clean_classification(classification: DataFrame) -> DataFrame:
    """Activity labels spelled as in the activities table."""
    return classification.withColumn("Activity", recode(F.col("Activity"), ACTIVITY_CLASS_RULES))
