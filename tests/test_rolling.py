from pyspark.sql import functions as F

from yearwheel.operators import rolling
from yearwheel.operators.checks import refuse_missing

import pytest

FACTS = "TripYear int, TripQtr int, Place string, Amount double"


def quarters(*pairs):
    return [(y, q, "x", 1.0) for y, q in pairs]


def test_complete_years_at_both_ends_and_around_a_gap(table, rows):
    seen = [(2000, q) for q in (2, 3, 4)] + [(2001, q) for q in (1, 2, 3, 4)] + [(2002, 2), (2002, 3)]
    df = table(FACTS, quarters(*seen))
    # 2002 Q1 is missing: no year that needs it is complete
    assert rows(rolling.complete_years(df)) == [("YEDec2001",), ("YEJun2001",), ("YEMar2001",), ("YESep2001",)]


def test_years_seen_whole_agrees_with_complete_years(table, rows):
    df = table(FACTS, quarters((1999, 4), (2000, 1), (2000, 2), (2000, 3), (2000, 4), (2001, 2)))
    quarterly = rolling.quarterly_totals(df, ["Place"], ["Amount"])
    totals = rolling.rolling_year_totals(quarterly, ["Place"], ["Amount"], seen="seen")
    assert rows(rolling.years_seen_whole(totals, "seen")) == rows(rolling.complete_years(df))


def test_quarters_of_different_members_add_up_to_a_complete_year(table, rows):
    df = table(FACTS, [(2000, q, place, 1.0) for q, place in zip((1, 2, 3, 4), "abab")])
    quarterly = rolling.quarterly_totals(df, ["Place"], ["Amount"])
    base = rolling.rolling_year_totals(quarterly, ["Place"], ["Amount"], rolling.complete_years(df))
    assert rows(base, "YE", "Place", "Amount") == [("YEDec2000", "a", 2.0), ("YEDec2000", "b", 2.0)]


def test_unpivot_gives_four_rows_per_row(table):
    df = rolling.with_year_ends(table(FACTS, quarters(*[(2000 + i, i % 4 + 1) for i in range(9)])))
    stacked = rolling.stack_year_ends(df)
    assert stacked.count() == 36
    assert stacked.where(F.substring("YE", 1, 5) != F.col("source")).count() == 0


def test_each_quarter_enters_four_years(table):
    df = table(FACTS, quarters(*[(y, q) for y in (2000, 2001, 2002) for q in (1, 2, 3, 4)]))
    quarterly = rolling.quarterly_totals(df, ["Place"], ["Amount"])
    every = rolling.rolling_year_totals(quarterly, ["Place"], ["Amount"])
    assert every.agg(F.sum("Amount")).first()[0] == 4 * 12
    complete = rolling.rolling_year_totals(quarterly, ["Place"], ["Amount"], rolling.complete_years(df))
    assert complete.where("Amount <> 4").count() == 0 and complete.count() == 9


def test_missing_values_are_refused_in_complete_years_only(table):
    whole = [(2000, q, "x", 1.0) for q in (1, 2, 3, 4)]

    def checked(extra):
        df = table(FACTS, whole + extra)
        quarterly = rolling.quarterly_totals(df, ["Place"], ["Amount"], count_nulls=True)
        carried = ["Amount", "Amount" + rolling.NULLS_SUFFIX]
        base = rolling.rolling_year_totals(quarterly, ["Place"], carried, rolling.complete_years(df))
        return refuse_missing(base, ["YE", "Place"], ["Amount"]).collect()

    assert [r.Amount for r in checked([(1990, 1, "x", None)])] == [4.0]
    with pytest.raises(Exception, match="missing values in Amount"):
        checked([(2000, 3, "x", None)])
    with pytest.raises(Exception, match="missing values in Place"):
        checked([(2000, 3, None, 1.0)])


def test_empty_in_empty_out(table):
    df = table(FACTS, [])
    quarterly = rolling.quarterly_totals(df, ["Place"], ["Amount"])
    assert rolling.rolling_year_totals(quarterly, ["Place"], ["Amount"], rolling.complete_years(df)).count() == 0


def test_quarterly_totals_shuffle_once_after_a_map_side_combine(table, plan):
    text = plan(rolling.quarterly_totals(table(FACTS, quarters((2000, 1))), ["Place"], ["Amount"]))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in text
