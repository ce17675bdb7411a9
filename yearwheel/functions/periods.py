"""Column expressions for quarters, year-end labels and month ends."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Year-end label prefix -> last quarter of that year.
YEAR_END_LABELS = {"YEMar": 1, "YEJun": 2, "YESep": 3, "YEDec": 4}


def year_end_label(prefix: str, year: Column, quarter: Column) -> Column:
    """Label of the year ending in ``prefix`` that the quarter belongs to; null in, null out."""
    last = YEAR_END_LABELS[prefix]
    carried = F.when(quarter <= last, 0).when(quarter > last, 1)
    return F.concat(F.lit(prefix), (year + carried).cast("string"))


def year_end_year(label: Column) -> Column:
    """``YEMar2003`` -> 2003."""
    return F.right(label, F.lit(4)).cast("int")


def year_end_quarter(label: Column) -> Column:
    """``YEMar2003`` -> 1."""
    prefix = F.substring(label, 1, 5)
    quarter = F.lit(None).cast("int")
    for name, last in YEAR_END_LABELS.items():
        quarter = F.when(prefix == name, last).otherwise(quarter)
    return quarter


def year_end_description(label: Column) -> Column:
    """``YEMar2003`` -> ``YEMar 2003``."""
    return F.concat(F.substring(label, 1, 5), F.lit(" "), F.right(label, F.lit(4)))


def quarter_end_date(year: Column, quarter: Column) -> Column:
    """Last day of the quarter."""
    return F.last_day(F.make_date(year, quarter * 3, F.lit(1)))


def lagged_month_end(month_end: Column, months: Column | int) -> Column:
    """Month end lying ``months`` before a month-end date."""
    back = F.lit(months) if isinstance(months, int) else months
    return F.last_day(F.add_months(month_end, -back))
