import pytest
from pyspark.sql import functions as F

from yearwheel.operators import checks, cube, dimensions
from yearwheel.operators.calendar import component_quarters, quarter_calendar, whole_years


def test_generated_lookup_sorts_without_regard_to_case(table):
    df = table("p string", [(v,) for v in ("Visiting Relatives", "Visiting friends", "All", "Business", "Business", None)])
    got = [tuple(r) for r in dimensions.generated_lookup(df, "p").orderBy("Code").collect()]
    assert got == [(1, "Business", 1), (2, "Visiting friends", 2), (3, "Visiting Relatives", 3), (4, "All", 4)]


def test_year_end_lookup_is_in_time_order(table):
    df = table("Year_Ending string", [(v,) for v in ("YEDec2003", "YEMar2003", "All", "YEJun2002", "YEMar2003")])
    got = [tuple(r) for r in dimensions.year_end_lookup(df, "Year_Ending").orderBy("Code").collect()]
    assert got == [
        (1, "YEJun 2002", 1, "YEJun2002"),
        (2, "YEMar 2003", 2, "YEMar2003"),
        (3, "YEDec 2003", 3, "YEDec2003"),
        (4, "All", 4, "All"),
    ]


def test_hierarchy_and_published_form(table, rows):
    lookup = table("Code int, Description string, SortOrder int", [(1, "a", 1), (2, "b, c", 2), (3, "All", 3)])
    assert rows(dimensions.hierarchy(lookup)) == [(3, 1), (3, 2)]
    assert rows(dimensions.published_lookup(lookup)) == [(1, '"a"', ""), (2, '"b, c"', ""), (3, '"All"', "")]


def test_encoding_drops_or_refuses_unknown_members(table, rows):
    facts = table("a string, b string, v string", [("x", "YEMar2001", "1"), ("y", "All", "2")])
    lookups = {
        "a": table("Code int, Description string", [(5, "x")]),
        "b": table("Code int, Description string, YE string", [(1, "YEMar 2001", "YEMar2001"), (2, "All", "All")]),
    }
    assert rows(dimensions.encode_dimensions(facts, lookups)) == [(5, 1, "1")]
    with pytest.raises(Exception, match="no code for a y"):
        dimensions.encode_dimensions(facts, lookups, on_unmatched="fail").collect()
    loss = dimensions.encoding_loss(facts, lookups).first().asDict()
    assert loss == {"rows_before": 2, "rows_after": 1, "lost_a": 1, "lost_b": 0}


def test_reconcile(table):
    df = table("x double", [(1.25,), (2.5,)])

    def ok(expected, how):
        return checks.reconcile(df, "c", F.sum("x"), expected, how).first().ok

    assert ok(3, "truncate") and not ok(4, "truncate")
    assert ok(4, "round") and not ok(3, "round")
    assert ok(4.2, "within") and not ok(4.3, "within") and not ok(3.2, "within")
    assert ok(table("e double", [(3.0,)]), "truncate")
    negative = table("x double", [(-1.7,)])
    assert checks.reconcile(negative, "c", F.sum("x"), -1).first().ok


def test_reconcile_fails_on_missing_totals(table):
    empty = table("x double", [])
    with pytest.raises(checks.CheckFailed):
        checks.require(checks.reconcile(empty, "c", F.sum("x"), 0))


def test_breakdowns_are_compared_in_both_directions(table):
    df = table("a string, b string, x double", [("k", "p", 1.0), ("l", "q", 2.0)])
    assert checks.reconcile_breakdowns(df, "c", "x", "a", "b").first().ok


def test_null_audit(table, rows):
    df = table("a string, b double", [(None, 1.0), ("x", None), (None, None)])
    assert rows(checks.null_audit(df)) == [("a", 2), ("b", 2)]


def test_whole_years_skip_a_gap(table, rows):
    seen = [(2000, 1), (2000, 2), (2000, 3), (2000, 4), (2001, 2), (2001, 3)]
    calendar = quarter_calendar(table("TripYear int, TripQtr int", seen * 2))
    years = whole_years(calendar)
    assert [str(r[0]) for r in rows(years, "whole_year")] == ["2000-12-31"]
    assert [str(r[0]) for r in rows(component_quarters(years))] == [
        "2000-03-31", "2000-06-30", "2000-09-30", "2000-12-31",
    ]


def test_numbering_holds_no_dimension_in_one_task(table, plan):
    names = [f"Customer#{i:05d}" for i in range(2000)] + ["customer#00001x", "a", "Ä"]
    df = table("k string", [(n,) for n in names])
    got = {r.Description: r.Code for r in dimensions.generated_lookup(df, "k").collect()}
    want = {m: i for i, m in enumerate(sorted(names, key=lambda n: (n.lower().encode(), n.encode())), 1)}
    assert got == want | {"All": len(names) + 1}
    assert "SinglePartition" not in plan(dimensions.generated_lookup(df, "k"))


def test_numbering_splits_members_that_begin_alike(spark, stage):
    alike = spark.range(20_000).select(F.lit("k").alias("key"), F.format_string("zzzzzzzzzzzz%08d", F.col("id") * 7919 % 20_000).alias("m"))
    odd = spark.createDataFrame([("k", "a"), ("l", "zzzz"), ("l", "a"), ("l", None)], "key string, m string")
    got = dimensions.numbered(alike.unionByName(odd), "key", F.lit(None), F.lower("m"), F.col("m"), "n", stage)
    numbers = {(r.key, r.m): r.n for r in got.collect()}
    want = ["a", *[f"zzzzzzzzzzzz{i:08d}" for i in range(20_000)]]
    assert numbers == {("k", m): i for i, m in enumerate(want, 1)} | {("l", None): 1, ("l", "a"): 2, ("l", "zzzz"): 3}


def test_numbering_gives_no_partition_more_than_its_share(spark, stage):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        alike = spark.range(20_000).select(F.lit("k").alias("key"), F.format_string("zzzzzzzzzzzz%08d", "id").alias("m"))
        odd = spark.createDataFrame([("k", "a")], "key string, m string")
        dimensions.numbered(alike.unionByName(odd), "key", F.lit(None), F.lower("m"), F.col("m"), "n", stage).count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in spark.read.parquet(f"{stage.folder}/*").groupBy("_part").count().collect()]
    assert sum(sizes) == 20_001 and max(sizes) < 2 * 20_001 / 4


@pytest.mark.parametrize("follows", [(), (("a", "g"),)])
def test_cube_of_codes_is_the_encoded_cube(table, rows, follows):
    data = [(a, "g" + a[:1], c, float(i)) for i, (a, c) in enumerate([("x1", "p"), ("x2", "q"), ("y1", "p"), ("y2", "r"), ("x1", "r"), ("y2", "r")])]
    base = table("a string, g string, c string, v double", data)
    whole = {
        "a": table("Code int, Description string", [(3, "x1"), (1, "y1"), (7, "y2"), (9, "x2"), (8, "All")]),
        "g": table("Code int, Description string", [(2, "gx"), (1, "gy"), (3, "All")]),
        "c": table("Code int, Description string", [(1, "p"), (2, "q"), (4, "r"), (5, "unused"), (3, "All")]),
    }
    fewer = whole | {"a": whole["a"].where("Description <> 'y2'"), "c": whole["c"].where("Description NOT IN ('q', 'r')")}
    no_total = whole | {"c": whole["c"].where("Description <> 'All'")}
    flat = cube.dimension_cube(base, ["a", "g", "c"], ["v"])
    for lookups in (whole, fewer, no_total):
        want = rows(dimensions.encode_dimensions(flat, lookups).select("a", "g", "c", "v"))
        assert rows(dimensions.coded_cube(base, lookups, ["v"], follows=follows).select("a", "g", "c", "v")) == want
    assert rows(dimensions.coded_cube(base, whole, ["v"], "fail", follows), "v") == rows(flat, "v")
    for lookups, member in ((fewer, "(a y2|c q|c r)"), (no_total, "c All")):
        with pytest.raises(Exception, match=f"no code for {member}"):
            dimensions.coded_cube(base, lookups, ["v"], "fail", follows).collect()
    assert dimensions.coded_cube(base.limit(0), whole, ["v"]).count() == 0


def test_codes_of_several_members(table, rows):
    lookup = table("Code int, Description string", [(1, "a"), (1, "b"), (2, "c")])
    assert rows(dimensions.shared_codes(lookup)) == [(1, 2)]


def test_require_counts_what_it_does_not_name(table):
    failing = table("control string, actual double, expected double, ok boolean", [(f"c{i:02d}", 1.0, 2.0, False) for i in range(30)])
    with pytest.raises(checks.CheckFailed, match="30 failed: .* and 10 more"):
        checks.require(failing)


def test_whole_years_of_repeated_rows_without_one_task(spark, rows, plan):
    numbers = [(2000 + k // 4, k % 4 + 1) for k in (0, 1, 2, 3, 4, 6, 7, 8, 9, 10)] * 3
    calendar = quarter_calendar(spark.createDataFrame(numbers, "TripYear int, TripQtr int"))
    twice = calendar.unionByName(calendar)
    years = whole_years(twice)
    assert [(r[1], r[2]) for r in rows(years.select("whole_year", "TripYear", "TripQtr"))] == [(2000, 4), (2001, 1), (2002, 2), (2002, 3)]
    assert years.where("lagged <> less9m").count() == 0
    assert "SinglePartition" not in plan(years)
