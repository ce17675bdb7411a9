"""Totals kept by quarter: refreshing some quarters equals building all of them again."""

from pathlib import Path

import pytest

from yearwheel.operators.staging import Staging
from yearwheel.plans import TotalsStore, extract_specs, survey_extract
from yearwheel.plans.store import years_of
from yearwheel.sources import SurveyTables

NAMES = ["accommodation", "trips", "spend", "activity"]


def survey(spark, drop=(), double=()):
    """Two trips a quarter from 2000 to 2002, with details; some quarters left out or with other weights."""
    trips, stays, spend, acts = [], [], [], []
    for k in range(24):
        year, qtr = 2000 + k // 8, k // 2 % 4 + 1
        if (year, qtr) in drop:
            continue
        w = float(k % 5 + 1) * (2 if (year, qtr) in double else 1)
        kind = ("Overnight Trip", "Day Trip")[k % 2]
        trips.append((k, kind, year, qtr, ["N", "S"][k % 3 % 2], "Holiday", w, w, w, float(k) if k % 2 == 0 else None, 1.0))
        stays += [(k, "Hotel", float(k % 3)), (k, "Hotel", float(k % 3)), (k, "Tent", 1.0)]
        spend += [(k, "Alcohol", 1.5), (k, "Food And Alcohol", float(k)), (k, "Gifts", 2.0), (k, "Gifts", 3.0)]
        acts += [(k, "Fishing"), (k, "Fishing"), (k, "Chess")]

    def table(schema, rows):
        return spark.createDataFrame(rows, schema)

    def lookup(members):
        return table("Code int, Description string, SortOrder int", [(i, m, i) for i, m in enumerate([*members, "All"], 1)])

    return SurveyTables(
        trips=table(
            "TripIDNumber long, TripType string, TripYear int, TripQtr int, DestinationRTO string, POV string, RespondentWeight double, "
            "SmoothedTripWeight double, ExpenditureWeight double, ImputedSpendAccom double, ImputedSpendTrnsport double", trips),
        stays=table("TripID long, AccommodationType string, NoNights double", stays),
        spend=table("TripID long, SpendType string, ImputedSpendAmt double", spend),
        activities=table("TripID long, Activities string", acts),
        purposes=table("POV string, POV_Group string", [("Holiday", "Leisure")]),
        classification=table("Activity string, Activity_Group string", [("Fishing", "Outdoor"), ("Chess", "Indoor")]),
        destinations=lookup(["N", "S"]),
        lengths_of_stay=lookup(["0 nights", "1 nights", "2 nights"]),
        accommodation_types=lookup(["Hotel", "Tent"]),
    )


@pytest.mark.parametrize(
    ("before", "after", "quarters"),
    [
        ({"drop": [(2002, 4)]}, {}, [(2002, 4)]),  # a quarter more
        ({"double": [(2001, 2)]}, {}, [(2001, 2)]),  # a correction
        ({}, {"drop": [(2001, 2), (2000, 1)]}, [(2001, 2), (2000, 1)]),  # withdrawn quarters
    ],
)
def test_refresh_equals_full_build(spark, tmp_path, rows, before, after, quarters):
    tables = survey(spark, **after)
    store = TotalsStore(spark, str(tmp_path / "store"))
    store.refresh(survey(spark, **before))
    store.refresh(tables, quarters)
    kept = store.facts()
    for name in NAMES:
        spec = extract_specs("S")[name]
        own = survey_extract(name, spec, tables, Staging(spark, str(tmp_path / f"own-{name}")))
        held = survey_extract(name, spec, tables, Staging(spark, str(tmp_path / f"held-{name}")), kept)
        assert rows(held.cube) == rows(own.cube), name
        assert rows(held.losses) == rows(own.losses)
        columns = sorted(own.quarterly.columns)
        assert rows(held.quarterly, *columns) == rows(own.quarterly, *columns)


def test_other_partitions_are_not_written(spark, tmp_path):
    store = TotalsStore(spark, str(tmp_path), ["trips"])
    store.refresh(survey(spark))
    files = lambda: {p: p.stat().st_mtime_ns for p in Path(tmp_path).rglob("*.parquet")}
    old = files()
    store.refresh(survey(spark, double=[(2001, 2)]), [(2001, 2)])
    new = files()
    touched = {"/".join(p.parts[-4:-1]) for p in old.keys() ^ new.keys()}
    assert {t.split("/", 1)[1] if t.startswith("quarters") else t for t in touched} == {
        "extract=trips/TripYear=2001/TripQtr=2", *[f"years/extract=trips/YE={y}" for y in years_of([(2001, 2)])]
    }


def test_only_the_quarters_are_read(spark, tmp_path):
    """The condition on quarters reaches the scan of the trips."""
    tables = survey(spark)
    path = str(tmp_path / "trips")
    tables.trips.write.parquet(path)
    from dataclasses import replace

    from yearwheel.plans import facts

    stored = replace(tables, trips=spark.read.parquet(path))
    text = facts.totalled(stored, ["trips"], [(2001, 2)])._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(TripYear,2001)" in text and "EqualTo(TripQtr,2)" in text


def test_years_of_a_quarter():
    assert years_of([(2000, 1)]) == ["YEDec2000", "YEJun2000", "YEMar2000", "YESep2000"]
    assert years_of([(2000, 4)]) == ["YEDec2000", "YEJun2001", "YEMar2001", "YESep2001"]


def test_refresh_of_nothing(spark, tmp_path):
    store = TotalsStore(spark, str(tmp_path), ["trips"])
    store.refresh(survey(spark), [])
    assert not list(Path(tmp_path).iterdir())
