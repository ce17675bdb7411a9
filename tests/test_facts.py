from yearwheel.plans.facts import totalled, wanted_tags
from yearwheel.sources.tables import SurveyTables


def survey(spark, table):
    trips = table(
        "TripIDNumber long, TripYear int, TripQtr int, TripType string, DestinationRTO string, POV string, RespondentWeight double, "
        "SmoothedTripWeight double, ExpenditureWeight double, ImputedSpendAccom double, ImputedSpendTrnsport double",
        [
            (1, 2000, 1, "Overnight Trip", "North", "Holiday", 1.0, 2.0, 3.0, 10.0, 100.0),
            (2, 2000, 1, "Day Trip", "North", "Holiday", 1.0, 4.0, 5.0, 7.0, 20.0),
            (3, 2000, 2, "Overnight Trip", "South", "Business", 1.0, 1.0, 1.0, 1.0, 1.0),
        ],
    )
    spend = table(
        "TripID long, SpendType string, ImputedSpendAmt double",
        # the transport of trip 1 stands beside what is derived, trip 9 is unknown
        [(1, "Transport", 1.0), (1, "Transport", 2.0), (2, "Gifts", None), (2, "Alcohol", 1.0), (9, "Alcohol", 1.0), (9, "Gifts", 1.0)],
    )
    stays = table("TripID long, AccommodationType string, NoNights int", [(1, "Hotel", 2), (1, "Hotel", 2), (1, "Motel", 20), (2, "Hotel", 1)])
    activities = table("TripID long, Activities string", [(1, "Walk"), (1, "Walk"), (2, "Swim"), (9, "Swim")])
    return SurveyTables(
        trips=trips, stays=stays, spend=spend, activities=activities, purposes=None, classification=None, destinations=None,
        lengths_of_stay=None, accommodation_types=None,
    )


def test_entries_are_not_made_one_by_one(spark, table, plan):
    """Lists are joined as they are; a function per entry is not compiled and took most of the pass."""
    text = plan(totalled(survey(spark, table), wanted_tags(["accommodation", "trips", "spend", "activity"], strict=True)))
    assert "transform(" not in text


def test_totals_of_all_tags(spark, table):
    found = totalled(survey(spark, table), wanted_tags(["accommodation", "trips", "spend", "activity"], strict=True)).collect()
    own = {t: [r for r in found if r.extract == t] for t in {r.extract for r in found}}
    spent = {(r.TripQtr, r.Trip_Type, r.Spend_Type): (r["spend:Expenditure"], r["spend:Expenditure_nulls"]) for r in own["spend"]}
    assert spent == {
        (1, "Overnight Trip", "Transport"): (309.0, 0), (1, "Overnight Trip", "Accomodation"): (30.0, 0), (1, "Day Trip", "Transport"): (100.0, 0),
        (1, "Day Trip", "Gifts"): (None, 1), (1, "Day Trip", "Alcohol"): (5.0, 0), (2, "Overnight Trip", "Transport"): (1.0, 0),
        (2, "Overnight Trip", "Accomodation"): (1.0, 0),
    }
    stays = {(r.Accommodation_Type, r["accommodation:Total_Trips"], r["accommodation:Total_Nights"], r["accommodation:Total_Respondents"]) for r in own["accommodation"]}
    assert stays == {("Hotel", 4.0, 8.0, 2), ("Motel", 2.0, 40.0, 1)}
    assert {(r.Trip_Type, r.TripQtr, r["trips:Total_Trips"]) for r in own["trips"]} == {("Overnight Trip", 1, 2.0), ("Day Trip", 1, 4.0), ("Overnight Trip", 2, 1.0)}
    assert {(r.Activities, r["activity:Total_Activities"], r["activity:Raw_Count"]) for r in own["activity"]} == {("Walk", 4.0, 2), ("Swim", 4.0, 1)}
    assert {(r.TripQtr, r["overnight:n_trips"]) for r in own["overnight"]} == {(1, 1), (2, 1)}
    # trip 2 has alcohol without food, and accommodation on a day trip; trip 9 is known to the rules only
    assert {(r.TripYear, r["rules:uneven"], r["rules:day_accommodation"]) for r in own["rules"]} == {(2000, 1, 35.0), (None, 1, None)}
