"""Length-of-stay bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AVERAGE_MONTH = 365.25 / 12

# Half-open bands above the single nights, bounds in nights.
LONG_STAY_BANDS = [
    (15.0, 1 * AVERAGE_MONTH, "15 nights to less than one month"),
    (1 * AVERAGE_MONTH, 2 * AVERAGE_MONTH, "One month to less than two months"),
    (2 * AVERAGE_MONTH, 3 * AVERAGE_MONTH, "Two months to less than three months"),
    (3 * AVERAGE_MONTH, 6 * AVERAGE_MONTH, "Three months to less than six months"),
    (6 * AVERAGE_MONTH, 12 * AVERAGE_MONTH, "Six months to less than one year"),
]
OUT_OF_BANDS = "Error - more than one year"


def length_of_stay_band(nights: Column) -> Column:
    """Band of a number of nights.

    Up to 14 nights the number itself is the band. A stay between 14 and 15 nights fits no band
    and is labelled like one of more than a year.
    """
    x = nights.cast("double")
    number = F.when(x == F.floor(x), x.cast("bigint").cast("string")).otherwise(x.cast("string"))
    band = F.when(x <= 14, F.concat(number, F.lit(" nights")))
    for low, high, label in LONG_STAY_BANDS:
        band = band.when((x >= low) & (x < high), F.lit(label))
    return band.when(x.isNotNull(), F.lit(OUT_OF_BANDS))
