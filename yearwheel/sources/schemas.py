"""Columns the extracts need, with their types. Other columns in the files are never parsed."""

from __future__ import annotations

# Stands for the numeric type chosen at read time: double, or a decimal for exact sums.
NUMBER = "number"

TRIPS = {
    "TripIDNumber": "bigint",
    "TripType": "string",
    "TripYear": "int",
    "TripQtr": "int",
    "DestinationRTO": "string",
    "POV": "string",
    "RespondentWeight": NUMBER,
    "SmoothedTripWeight": NUMBER,
    "ExpenditureWeight": NUMBER,
    "ImputedSpendAccom": NUMBER,
    "ImputedSpendTrnsport": NUMBER,
}
STAYS = {"TripID": "bigint", "AccommodationType": "string", "NoNights": NUMBER}
SPEND = {"TripID": "bigint", "SpendType": "string", "ImputedSpendAmt": NUMBER}
ACTIVITIES = {"TripID": "bigint", "Activities": "string"}
LOOKUP = {"Code": "int", "Description": "string", "SortOrder": "int"}
