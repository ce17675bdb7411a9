"""Spend by type: weighting, netting of overlapping types, types derived from trip columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearwheel.operators.clean import DAY, OVERNIGHT

TRIP = "TripIDNumber"

# Spend types, spelled as published.
ALCOHOL = "Alcohol"
FOOD_AND_ALCOHOL = "Food And Alcohol"
FOOD = "FoodAndBeverages"
ACCOMMODATION = "Accomodation"
TRANSPORT = "Transport"


def weighted_spend(trips: DataFrame, spend: DataFrame) -> DataFrame:
    """Trip, spend type and weighted expenditure of each spend row."""
    weights = trips.select(TRIP, "ExpenditureWeight")
    joined = weights.join(spend, weights[TRIP] == spend["TripID"])
    amount = F.col("ExpenditureWeight") * F.col("ImputedSpendAmt")
    return joined.select(TRIP, "SpendType", amount.alias("Expenditure"))


def spread_types(
    spend: DataFrame,
    types: Sequence[str],
    key: str = TRIP,
    value: str = "Expenditure",
    fill: float | None = None,
) -> DataFrame:
    """One row per key, one column per spend type; other types are ignored.

    A missing type is null, or ``fill``. Rows that share key and type are added up; use
    :func:`uneven_types` where they must not occur. Conditional sums need one shuffle by key, after
    a map-side combine; ``pivot`` would take a second one, by key and type.
    """
    columns = [F.sum(F.when(F.col("SpendType") == t, F.col(value))).alias(t) for t in types]
    out = spend.where(F.col("SpendType").isin(*types)).groupBy(key).agg(*columns)
    return out if fill is None else out.fillna(fill, list(types))


def weighted_types(
    trips: DataFrame, spend: DataFrame, types: Sequence[str], fill: float | None = None
) -> DataFrame:
    """One row per trip with the weighted expenditure of each type in a column.

    Spend is summed by trip first and weighted after the join, which finds it already partitioned
    by trip. A trip with very many rows is combined in the map stage and joins as one row.
    """
    wide = spread_types(spend, types, key="TripID", value="ImputedSpendAmt", fill=fill)
    weights = trips.select(TRIP, "ExpenditureWeight")
    joined = weights.join(wide, weights[TRIP] == wide["TripID"])
    return joined.select(TRIP, *[(F.col("ExpenditureWeight") * F.col(f"`{t}`")).alias(t) for t in types])


def uneven_types(spend: DataFrame, types: Sequence[str], key: str = TRIP) -> DataFrame:
    """Keys that have some of ``types`` but not each exactly once, with the rows per type.

    Counts are combined before the shuffle, so a key with very many rows costs no more than others.
    """
    counts = [F.count_if(F.col("SpendType") == t).alias(t) for t in types]
    per_key = spend.where(F.col("SpendType").isin(*types)).groupBy(key).agg(*counts)
    uneven = F.lit(False)
    for t in types:
        uneven = uneven | (F.col(t) != 1)
    return per_key.where(uneven)


def net_component(wide: DataFrame) -> DataFrame:
    """Food without alcohol in place of food with alcohol."""
    net = F.col(f"`{FOOD_AND_ALCOHOL}`") - F.col(ALCOHOL)
    return wide.withColumn(FOOD, net).drop(FOOD_AND_ALCOHOL)


def gather_types(wide: DataFrame, types: Sequence[str] = (ALCOHOL, FOOD), key: str = TRIP) -> DataFrame:
    """Back to one row per key and spend type."""
    return wide.unpivot([key], list(types), "SpendType", "Expenditure")


def derived_entries(kind: str = "SpendType") -> Column:
    """Array of a trip's one or two derived entries: type, under the name ``kind``, and Expenditure."""
    weight = F.col("ExpenditureWeight")

    def entry(value: str, amount: str) -> Column:
        return F.struct(F.lit(value).alias(kind), (weight * F.col(amount)).alias("Expenditure"))

    transport = entry(TRANSPORT, "ImputedSpendTrnsport")
    both = F.array(entry(ACCOMMODATION, "ImputedSpendAccom"), transport)
    return F.when(F.col("TripType") == OVERNIGHT, both).otherwise(F.array(transport))


def derived_spend(trips: DataFrame) -> DataFrame:
    """Weighted accommodation spend of overnight trips and transport spend of all trips.

    Both come out of one scan: each trip is exploded into its one or two rows.
    """
    kept = [c for c in trips.columns if c not in ("ExpenditureWeight", "ImputedSpendAccom", "ImputedSpendTrnsport")]
    return trips.select(*kept, F.inline(derived_entries()))


def combined_spend(trips: DataFrame, spend: DataFrame, fill: float | None = None) -> DataFrame:
    """Trip-level spend of all types, alcohol taken out of food: TripIDNumber, SpendType, Expenditure."""
    pair = [ALCOHOL, FOOD_AND_ALCOHOL]
    food = gather_types(net_component(weighted_types(trips, spend, pair, fill)))
    rest = weighted_spend(trips, spend.where(~F.col("SpendType").isin(*pair)))
    derived = derived_spend(trips).select(TRIP, "SpendType", "Expenditure")
    return rest.unionByName(food).unionByName(derived)


def net_totals(totals: DataFrame, amount: str = "Expenditure", kind: str = "SpendType") -> DataFrame:
    """Take alcohol out of food in totals by spend type.

    Sums are linear: subtracting the alcohol total from the food total is the same as netting each
    trip, with a missing type of the pair as 0. So fact rows are never grouped by trip for it. The
    difference is left as two rows of opposite sign, for the next sum to join. Food always comes
    with a row of alcohol, as spreading gives a trip both types once it has one.
    """
    kept = [c for c in totals.columns if c not in (kind, amount)]
    value, zero = F.col(amount), F.lit(0).cast(totals.schema[amount].dataType)

    def entry(name: str | Column, contribution: Column) -> Column:
        name = F.lit(name) if isinstance(name, str) else name
        return F.struct(name.alias(kind), contribution.alias(amount))

    own = F.array(entry(F.col(kind), value))
    alcohol = F.array(entry(ALCOHOL, value), entry(FOOD, -value))
    food = F.array(entry(FOOD, value), entry(ALCOHOL, zero))
    entries = (
        F.when(F.col(kind) == ALCOHOL, alcohol).when(F.col(kind) == FOOD_AND_ALCOHOL, food).otherwise(own)
    )
    return totals.select(*kept, F.inline(entries))


def day_trip_accommodation(trips: DataFrame) -> DataFrame:
    """Weighted accommodation spend of day trips; must be zero."""
    amount = F.col("ExpenditureWeight") * F.col("ImputedSpendAccom")
    return trips.where(F.col("TripType") == DAY).agg(F.coalesce(F.sum(amount), F.lit(0)).alias("total"))
