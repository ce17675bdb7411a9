"""Quarter-end calendars: whole years and the quarters they consist of."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearwheel.functions.periods import lagged_month_end, quarter_end_date

QUARTER_END = "QEDate"


def quarter_calendar(df: DataFrame, year: str = "TripYear", quarter: str = "TripQtr") -> DataFrame:
    """Distinct quarters of a table with their end dates."""
    return (
        df.select(year, quarter)
        .distinct()
        .select(quarter_end_date(F.col(year), F.col(quarter)).alias(QUARTER_END), year, quarter)
    )


def whole_years(calendar: DataFrame) -> DataFrame:
    """Quarters that end a whole year: they and the three before them are in the calendar.

    Each quarter sets a bit in the four years it may belong to; a year with all four bits is whole. Repeated rows
    of the calendar count once, and nothing meets in one task.
    """
    quarters = calendar.distinct()
    run = F.year(QUARTER_END) * 4 + F.quarter(QUARTER_END)
    years = F.inline(F.array(*[F.struct((run + k).alias("run"), F.lit(1 << k).alias("bit")) for k in range(4)]))
    whole = quarters.select(years).groupBy("run").agg(F.bit_or("bit").alias("bits")).where(F.col("bits") == 0b1111)
    start = lagged_month_end(F.col(QUARTER_END), 9)
    return (
        quarters.withColumn("run", run)
        .join(whole.select("run"), "run", "left_semi")
        .drop("run")
        .withColumns({"lagged": start, "less9m": start})
        .withColumnRenamed(QUARTER_END, "whole_year")
    )


def component_quarters(years: DataFrame, year_end: str = "whole_year") -> DataFrame:
    """Distinct quarter ends that make up the whole years."""
    offsets = F.explode(F.array(*[F.lit(months) for months in (0, 3, 6, 9)]))
    return (
        years.select(year_end, offsets.alias("months"))
        .select(lagged_month_end(F.col(year_end), F.col("months")).alias("quarter_end"))
        .distinct()
    )
