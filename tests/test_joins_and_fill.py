import random

import pytest
from pyspark.sql import functions as F

from yearwheel.operators import clean, joins
from yearwheel.operators.fill import forward_fill


def filled(records):
    """Plain reference: last value at a smaller or equal position, per key."""
    out, last = {}, {}
    for key, pos, value in sorted(records, key=lambda r: r[1]):
        last[key] = value if value is not None else last.get(key)
        out[key, pos] = last[key]
    return out


@pytest.mark.parametrize(("span", "levels"), [(4, 0), (4, 1), (4, 2), (2, 3), (65536, 2)])
def test_forward_fill(table, span, levels):
    rng = random.Random(span * 10 + levels)
    positions = rng.sample(range(-50, 400), 120)
    records = [(rng.choice("kl"), p, rng.choice([None, None, None, "u", "v", "w"])) for p in positions]
    df = table("key string, pos bigint, value string", records)
    got = forward_fill(df, "value", "pos", ["key"], span=span, levels=levels)
    assert got.columns == df.columns
    assert {(r.key, r.pos): r.value for r in got.collect()} == filled(records)
    whole = [("", p, v) for _, p, v in records]
    got = forward_fill(df, "value", "pos", span=span, levels=levels)
    assert {("", r.pos): r.value for r in got.collect()} == filled(whole)


@pytest.mark.parametrize("levels", [0, 1, 2, 3])
def test_forward_fill_keeps_rows_without_key_or_position(table, levels):
    records = [("k", 1, "u"), ("k", 5, None), (None, 2, "v"), (None, 9, None), ("k", None, "w"), ("k", None, None), (None, None, None)]
    df = table("key string, pos bigint, value string", records)
    got = forward_fill(df, "value", "pos", ["key"], span=2, levels=levels)
    found = sorted((str(r.key), str(r.pos), str(r.value)) for r in got.collect())
    assert found == sorted(
        [("k", "1", "u"), ("k", "5", "u"), ("None", "2", "v"), ("None", "9", "v"), ("k", "None", "w"), ("k", "None", "None"), ("None", "None", "None")]
    )


def test_forward_fill_crosses_long_runs_without_values(table):
    df = table("pos bigint, value string", [(1, "a"), *[(i, None) for i in range(2, 200)], (10**9, None)])
    got = forward_fill(df, "value", "pos", span=8).select("value").distinct().collect()
    assert [r[0] for r in got] == ["a"]


TRIPS = "TripIDNumber bigint, TripType string, DestinationRTO string, POV string, SmoothedTripWeight double"


def test_cleaning_fills_and_recodes(table, rows):
    df = table(TRIPS, [(1, "Day Trip", "Other   ", None, None), (2, "Day Trip", "Other", "REFUSED", 2.0)])
    assert rows(clean.clean_trips(df)) == [
        (1, "Day Trip", "Other", "None", 0.0),
        (2, "Day Trip", "Other", "Refused", 2.0),
    ]


def test_stays_are_banded_after_filling(table, rows):
    df = table(
        "TripID bigint, AccommodationType string, NoNights double, Other string",
        [(1, "Employer provided accomodation", None, "x"), (1, "Motels", 3.0, "y")],
    )
    assert rows(clean.clean_stays(df)) == [
        (1, "Employer provided accommodation", 0.0, "0 nights"),
        (1, "Motels", 3.0, "3 nights"),
    ]


def test_weights_repeat_on_every_detail_row(table, rows):
    trips = table("TripIDNumber bigint, w double", [(1, 2.0), (2, 3.0), (3, 4.0)])
    details = table("TripID bigint, kind string", [(1, "a"), (1, "b"), (3, "a"), (9, "a"), (None, "a")])
    assert rows(joins.with_details(trips, details)) == [(1, 2.0, "a"), (1, 2.0, "b"), (3, 4.0, "a")]


def test_trips_with_details_count_once(table, rows):
    trips = table("TripIDNumber bigint, w double", [(1, 2.0), (2, 3.0), (3, 4.0)])
    details = table("TripID bigint", [(1,)] * 5 + [(3,), (None,)])
    assert rows(joins.trips_with(trips, details)) == [(1, 2.0), (3, 4.0)]


def test_concordances(table, rows):
    known = table("POV string, POV_Group string", [("a", "A"), ("b", "B")])
    trips = table("POV string", [("a",), ("a",), ("c",)])
    assert rows(joins.with_purpose_group(trips, known)) == [("a", "A"), ("a", "A")]
    assert rows(joins.unused_values(known, trips, "POV"), "POV") == [("b",)]
    assert rows(joins.unused_values(trips, known, "POV"), "POV") == [("c",)]


def test_missing_activity_is_an_error(table):
    df = table("TripID bigint, Activities string, LegNumber int", [(1, "Business   ", 1), (2, None, 1)])
    got = clean.clean_activities(df.where("TripID = 1"))
    assert got.columns == ["TripID", "Activities"] and got.first().Activities == "Business"
    classes = table("Activity string, Activity_Group string", [("Business", "Work")])
    with pytest.raises(Exception, match="missing value in Activities"):
        joins.with_activity_group(clean.clean_activities(df), classes).collect()


def test_a_hot_trip_is_split_and_its_result_whole(spark):
    """One trip owns a third of the details: adaptive execution splits its partition."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        n = 120_000
        hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 30_000)
        details = spark.range(0, n, 1, 8).select(hot.alias("TripID"), F.sha2(F.col("id").cast("string"), 256).alias("kind"))
        trips = spark.range(0, 30_000, 1, 4).select(F.col("id").alias("TripIDNumber"), F.lit(2).alias("w"))
        joined = joins.with_details(trips, details)
        result = joined.groupBy(F.substring("kind", 1, 1).alias("k")).agg(F.sum("w").alias("w"), F.count("*").alias("n"))
        got = result.collect()
        assert sum(r.n for r in got) == n and sum(r.w for r in got) == 2 * n
        assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_bucketed_tables_join_without_a_shuffle(spark, table, plan):
    from yearwheel.plans.extracts import accommodation_rows

    trips = table(
        "TripIDNumber bigint, TripType string, TripYear int, TripQtr int, DestinationRTO string, "
        "RespondentWeight double, SmoothedTripWeight double",
        [(i, "Overnight Trip", 2000, 1, "North", 1.0, 2.0) for i in range(20)],
    )
    stays = table("TripID bigint, AccommodationType string, NoNights double", [(i, "Motels", 1.0) for i in range(20)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        trips.write.mode("overwrite").bucketBy(4, "TripIDNumber").sortBy("TripIDNumber").saveAsTable("trips_by_trip")
        stays.write.mode("overwrite").bucketBy(4, "TripID").sortBy("TripID").saveAsTable("stays_by_trip")
        rows = accommodation_rows(spark.table("trips_by_trip"), spark.table("stays_by_trip"))
        assert "SortMergeJoin" in plan(rows) and "Exchange" not in plan(rows)
        assert rows.count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS trips_by_trip")
        spark.sql("DROP TABLE IF EXISTS stays_by_trip")
