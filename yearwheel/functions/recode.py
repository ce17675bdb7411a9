"""Value recodes and the fixed rules of the survey vocabulary."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Recodes, exact in case and in trailing blanks.
DESTINATION_RULES = {"Other   ": "Other"}
SPEND_TYPE_RULES = {"Other   ": "Other"}
ACTIVITY_RULES = {"Business   ": "Business"}
ACCOMMODATION_RULES = {"Employer provided accomodation": "Employer provided accommodation"}
PURPOSE_RULES = {
    "REFUSED": "Refused",
    "Business   ": "Business",
    "Other Reason (specify)": "Other",
    "Education Or Study": "Education/Study",
    "Conference Or Convention": "Conference or Convention",
    "Attending wedding/Family Occasion/Funeral": "Attending Wedding/Family Occasion/Funerals",
    "Visiting relatives": "Visiting Relatives",
    "Participating in sports activity": "Participation in Sports Activity",
    "Publicised special event": "Publicised Special Event",
}
ACTIVITY_CLASS_RULES = {
    "Walk in City": "Walk In City",
    "Refused To Answer": "Refused to Answer",
    "Scenic Flight (heli, plane)": "Scenic Flight (Heli, Plane)",
    "Cycling (on-road)": "Cycling (On-road)",
    "Arts and Crafts": "Arts And Crafts",
    "Mountain Biking (off-road)": "Mountain Biking (Off-road)",
    "Zoos/Wildlife/Marine Parks (e.g. Kelly Tarltons, Orana Park,": (
        "Zoos/Wildlife/Marine Parks (e.g. Kelly Tarltons, Orana Park, Wellington Zoo)"
    ),
    "Personal Business (incl. family help/financial/househunting)": (
        "Personal Business (incl. family help/financial/house hunting)"
    ),
    "Dont Know": "Dont know",
}

# Fixed value: category given to a missing purpose of visit.
NO_PURPOSE = "None"


def recode(column: Column, rules: Mapping[str, str]) -> Column:
    """Replace the values named in ``rules``; all others, nulls included, pass unchanged."""
    out = None
    for old, new in rules.items():
        out = F.when(column == old, new) if out is None else out.when(column == old, new)
    return column if out is None else out.otherwise(column)
