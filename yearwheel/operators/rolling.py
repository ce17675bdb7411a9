"""Quarterly totals, complete years and rolling-year totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearwheel.functions.periods import YEAR_END_LABELS, year_end_label

YEAR = "TripYear"
QUARTER = "TripQtr"
YEAR_END = "YE"
LABELS = list(YEAR_END_LABELS)
NULLS_SUFFIX = "_nulls"


def with_year_ends(df: DataFrame, year: str = YEAR, quarter: str = QUARTER) -> DataFrame:
    """Add the four year-end labels a quarter belongs to."""
    return df.withColumns({name: year_end_label(name, F.col(year), F.col(quarter)) for name in LABELS})


def stack_year_ends(df: DataFrame, source: str = "source") -> DataFrame:
    """Turn the four label columns into four rows; column ``source`` keeps the label's origin."""
    ids = [c for c in df.columns if c not in LABELS]
    return df.unpivot(ids, LABELS, source, YEAR_END)


def complete_years(df: DataFrame, year: str = YEAR, quarter: str = QUARTER) -> DataFrame:
    """Year-ends (column ``YE``) of which all four quarters occur in ``df``.

    Counts the distinct quarters per label. Only quarters are shuffled, after a map-side distinct.
    """
    quarters = df.select(year, quarter).distinct()
    return (
        stack_year_ends(with_year_ends(quarters, year, quarter))
        .where(F.col(YEAR_END).isNotNull())
        .groupBy(YEAR_END)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") == 4)
        .select(YEAR_END)
    )


def quarterly_totals(
    df: DataFrame,
    dims: Sequence[str],
    measures: Sequence[str],
    *,
    year: str = YEAR,
    quarter: str = QUARTER,
    rows: str | None = None,
    count_nulls: bool = False,
) -> DataFrame:
    """Sums per quarter and dimension combination: the one pass over the fact rows.

    Year and quarter stand for the four labels, which they determine, so the shuffle key holds two
    integers instead of four strings. ``rows`` names a row count; ``count_nulls`` adds the number of
    missing values per measure, because a sum alone would hide them.
    """
    totals = [F.sum(m).alias(m) for m in measures]
    if rows:
        totals.append(F.count(F.lit(1)).alias(rows))
    if count_nulls:
        totals += [F.count_if(F.col(m).isNull()).alias(m + NULLS_SUFFIX) for m in measures]
    return df.groupBy(year, quarter, *dims).agg(*totals)


def rolling_year_totals(
    quarterly: DataFrame,
    dims: Sequence[str],
    measures: Sequence[str],
    complete: DataFrame | None = None,
    *,
    year: str = YEAR,
    quarter: str = QUARTER,
    seen: str | None = None,
) -> DataFrame:
    """Sums per year-end (column ``YE``) and dimension combination.

    Takes quarterly totals, so each fact row is stacked as part of its quarter and never four times
    on its own. With ``complete`` given, other years leave before the aggregation. ``seen`` names a
    column for the set of quarters found, one bit each, from which :func:`years_seen_whole` tells
    the complete years without going back to the quarters.
    """
    stacked = stack_year_ends(with_year_ends(quarterly, year, quarter))
    if complete is not None:
        stacked = stacked.join(complete, YEAR_END, "left_semi")
    totals = [F.sum(m).alias(m) for m in measures]
    if seen:
        totals.append(F.bit_or(F.expr(f"shiftleft(1, `{quarter}` - 1)")).alias(seen))
    return stacked.groupBy(YEAR_END, *dims).agg(*totals)


def years_seen_whole(totals: DataFrame, seen: str) -> DataFrame:
    """Year-ends whose rows together have seen all four quarters."""
    return (
        totals.where(F.col(YEAR_END).isNotNull())
        .groupBy(YEAR_END)
        .agg(F.bit_or(seen).alias("quarters"))
        .where(F.col("quarters") == 0b1111)
        .select(YEAR_END)
    )
