from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from yearwheel.operators import spend
from yearwheel.operators.checks import CheckFailed, no_rows, require, zero_total

PAIR = [spend.ALCOHOL, spend.FOOD_AND_ALCOHOL]
SPEND = "TripIDNumber bigint, SpendType string, Expenditure double"
TRIPS = (
    "TripIDNumber bigint, TripType string, ExpenditureWeight double, "
    "ImputedSpendAccom double, ImputedSpendTrnsport double"
)


@pytest.fixture
def sample(table):
    return table(
        SPEND,
        [
            (1, "Alcohol", 2.0),
            (1, "Food And Alcohol", 10.0),
            (1, "Gifts", 5.0),
            (2, "Alcohol", 3.0),
            (3, "Food And Alcohol", 7.0),
        ],
    )


def test_spread_net_and_gather(sample, rows):
    wide = spend.spread_types(sample, PAIR)
    assert rows(wide, "TripIDNumber", *[f"`{c}`" for c in PAIR]) == [(1, 2.0, 10.0), (2, 3.0, None), (3, None, 7.0)]
    net = spend.net_component(wide)
    assert net.columns == ["TripIDNumber", "Alcohol", "FoodAndBeverages"]
    long = {(r[0], r[1]): r[2] for r in spend.gather_types(net).collect()}
    assert long == {
        (1, "Alcohol"): 2.0,
        (1, "FoodAndBeverages"): 8.0,
        (2, "Alcohol"): 3.0,
        (2, "FoodAndBeverages"): None,
        (3, "Alcohol"): None,
        (3, "FoodAndBeverages"): None,
    }


def test_uneven_types_are_found(sample, table, rows):
    assert rows(spend.uneven_types(sample, PAIR)) == [(2, 1, 0), (3, 0, 1)]
    even = sample.where("TripIDNumber = 1")
    require(no_rows(spend.uneven_types(even, PAIR), "uneven"))
    twice = even.unionByName(table(SPEND, [(1, "Alcohol", 1.0), (1, "Gifts", 1.0)]))
    with pytest.raises(CheckFailed, match="uneven: 1.0 instead of 0.0"):
        require(no_rows(spend.uneven_types(twice, PAIR), "uneven"))


def test_spreading_shuffles_once(sample, plan):
    text = plan(spend.spread_types(sample, PAIR))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in text


def test_derived_types_of_day_and_overnight_trips(table, rows):
    trips = table(TRIPS, [(1, "Day Trip", 2.0, 0.0, 3.0), (2, "Overnight Trip", 10.0, 4.0, 5.0)])
    assert rows(spend.derived_spend(trips), "TripIDNumber", "SpendType", "Expenditure") == [
        (1, "Transport", 6.0),
        (2, "Accomodation", 40.0),
        (2, "Transport", 50.0),
    ]


def test_netted_totals_equal_the_netted_table(sample, plan):
    def totals(df):
        out = defaultdict(float)
        for r in df.collect():
            out[r.SpendType] += r.Expenditure
        return dict(out)

    trips = sample.select("TripIDNumber").distinct().selectExpr(
        "TripIDNumber", "'Day Trip' TripType", "2D ExpenditureWeight", "0D ImputedSpendAccom", "0D ImputedSpendTrnsport"
    )
    raw = sample.selectExpr("TripIDNumber TripID", "SpendType", "Expenditure ImputedSpendAmt")
    by_trip = spend.combined_spend(trips, raw, fill=0).where("SpendType <> 'Transport'")
    by_type = spend.weighted_spend(trips, raw).groupBy("SpendType").agg(F.sum("Expenditure").alias("Expenditure"))
    assert totals(spend.net_totals(by_type)) == totals(by_trip)
    assert plan(spend.net_totals(by_type)).count("Exchange") == plan(by_type).count("Exchange")


def test_food_alone_still_gives_alcohol(sample):
    only = spend.net_totals(sample.where("TripIDNumber = 3"))
    assert {(r.SpendType, r.Expenditure) for r in only.collect()} == {("FoodAndBeverages", 7.0), ("Alcohol", 0.0)}


def test_day_trip_accommodation_rule(table):
    fine = table(TRIPS, [(1, "Day Trip", 2.0, 0.0, 3.0), (2, "Overnight Trip", 10.0, 4.0, 5.0)])
    require(zero_total(spend.day_trip_accommodation(fine), "rule"))
    bad = table(TRIPS, [(1, "Day Trip", 2.0, 1.0, 3.0)])
    with pytest.raises(CheckFailed, match="rule: 2.0 instead of 0.0"):
        require(zero_total(spend.day_trip_accommodation(bad), "rule"))
    assert zero_total(spend.day_trip_accommodation(bad.where(F.lit(False))), "rule").first().ok
