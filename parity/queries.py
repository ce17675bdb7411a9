"""One registered query per operator, on the given tables."""

from __future__ import annotations

import atexit
import contextlib
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parity import tables as t
from yearwheel.functions import length_of_stay_band, measure_text, recode
from yearwheel.functions.recode import (
    ACCOMMODATION_RULES,
    ACTIVITY_CLASS_RULES,
    ACTIVITY_RULES,
    DESTINATION_RULES,
    PURPOSE_RULES,
    SPEND_TYPE_RULES,
)
from yearwheel.operators import calendar, checks, clean, cube, dimensions, fill, joins, rolling, spend
from yearwheel.operators.staging import Staging
from yearwheel.plans import Control, TotalsStore, extract_specs, fact_pass, survey_extract
from yearwheel.plans.extracts import (
    Extract,
    accommodation_rows,
    activity_rows,
    build_extract,
    trip_rows,
    with_activity_groups,
    with_group,
)
from yearwheel.sources import schemas
from yearwheel.sources.tables import SurveyTables, read_classification, read_lookup, read_purposes, read_table

SPECS = extract_specs("Survey")
_stagings: list[Staging] = []


def staging(spark: SparkSession) -> Staging:
    """Staging whose folder goes when the Python process of the session ends."""
    _stagings.append(Staging(spark))
    return _stagings[-1]


@atexit.register
def _drop_all() -> None:
    for stage in _stagings:
        with contextlib.suppress(Exception):  # the session may have ended before
            stage.drop()


TRIP_DIMS = SPECS["trips"].dims
TRIP_MEASURES = SPECS["trips"].measure_codes


def _doubles(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# ------------------------------------------------------------------ shared steps


def _extract(name: str, spark: SparkSession, d: str) -> Extract:
    """The production extract on the given tables."""
    return survey_extract(name, SPECS[name], _survey(spark, d), staging(spark))


def _survey(spark: SparkSession, d: str) -> SurveyTables:
    return SurveyTables(
        trips=t.trips(spark, d),
        stays=t.stays(spark, d),
        spend=t.spend_lines(spark, d),
        activities=t.activities(spark, d),
        purposes=t.purposes(spark),
        classification=t.classification(spark, d),
        destinations=t.destinations(spark, d),
        lengths_of_stay=t.lookup(spark, t.BANDS),
        accommodation_types=t.lookup(spark, t.ACCOMMODATION_TYPES),
    )


def _base(name: str, spark: SparkSession, d: str) -> DataFrame:
    return _extract(name, spark, d).base


def _cube_query(name: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        return _doubles(_extract(name, spark, d).cube, *SPECS[name].measure_codes)

    return query


def _extract_query(name: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        return _extract(name, spark, d).data

    return query


# ------------------------------------------------------------------ sources, projections, filters


def scan_trips(spark, d):
    """Typed columns of a parquet table by the production reader, narrowed, renamed and joined."""
    columns = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": schemas.NUMBER}
    orders = read_table(spark, f"{d}/orders.parquet", columns, fmt="parquet", number=t.MONEY)
    places = t.load(spark, d, "customer").join(t.load(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    day = F.col("o_orderstatus") == "F"
    out = orders.join(places, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("TripIDNumber"),
        F.when(day, clean.DAY).otherwise(clean.OVERNIGHT).alias("Trip_Type"),
        F.col("n_name").alias("Destination_RTO"),
        F.col("o_totalprice").alias("Total_Trips"),
    )
    return _doubles(out, "Total_Trips")


def lookup_prebuilt(spark, d):
    """Types of the parts as a lookup file with CR LF and quoted members, read by the production reader."""
    types = t.load(spark, d, "part").select("p_type").distinct()
    known = types.join(t.lookup(spark, t.ACCOMMODATION_TYPES), F.col("p_type") == F.col("Description"))
    line = F.format_string('%d,"%s",%d', "Code", "Description", "Code").alias("value")
    lines = known.select(F.col("Code").alias("at"), line)
    lines = lines.unionByName(spark.createDataFrame([(0, "Code,Description,SortOrder")], "at int, value string"))
    path = f"{staging(spark).folder}/lookup"
    lines.coalesce(1).sortWithinPartitions("at").select("value").write.option("lineSep", "\r\n").text(path)
    read = read_lookup(spark, path)
    coded = t.stays(spark, d).join(read, F.col("AccommodationType") == F.col("Description"))
    return coded.groupBy("Code", "Description").agg(F.count(F.lit(1)).alias("n_stays"))


def purpose_concordance(spark, d):
    """Purposes as a file with line feeds and repeated names in its header, read by the production reader."""
    header = 'c,d,g,"g\n(1)",b,bd,g,"g\n(2)"'
    lines = spark.createDataFrame([(0, header)], "at int, value string").unionByName(
        t.purposes(spark).select(F.lit(1).alias("at"), F.concat_ws(",", F.lit(1), "POV", *[F.lit("x")] * 5, "POV_Group").alias("value"))
    )
    path = f"{staging(spark).folder}/purposes"
    lines.coalesce(1).sortWithinPartitions("at").select("value").write.option("lineSep", "\r\n").text(path)
    used = clean.clean_trips(t.trips(spark, d)).groupBy("POV").agg(F.count(F.lit(1)).alias("n_trips"))
    return read_purposes(spark, path).join(used, "POV", "left").fillna(0, ["n_trips"])


def purpose_group(spark, d):
    known = joins.with_purpose_group(
        clean.clean_trips(t.trips(spark, d)), t.purposes(spark, t.PARTIAL_PURPOSES)
    )
    out = known.groupBy("POV_Group").agg(
        F.count(F.lit(1)).alias("n_trips"), F.sum("SmoothedTripWeight").alias("Total_Trips")
    )
    return _doubles(out, "Total_Trips")


def _gappy(spark, d):
    """Sparse classification with a nullable key and rows without a position."""
    key = F.when(F.col("pos") % 11 != 0, F.col("pos") % 3)
    pos = F.when(F.col("pos") % 13 != 0, F.col("pos"))
    return t.sparse_classification(spark, d).withColumns({"k": key, "spot": pos})


def forward_fill(spark, d):
    filled = fill.forward_fill(_gappy(spark, d), "Activity_Group", "spot", ["k"], span=64, levels=2)
    return filled.select("pos", "spot", "k", "Activity_Group", "Activity")


def activity_classification(spark, d):
    """Sparse classification staged as a file and read, filled and recoded by the production reader."""
    stage = staging(spark)
    stage(t.sparse_classification(spark, d), "sparse")
    named = read_classification(spark, f"{stage.folder}/sparse", fmt="parquet")
    return named.groupBy("Activity_Group", "Activity").agg(F.count(F.lit(1)).alias("n"))


def weighted_measures(spark, d):
    rows = joins.with_details(clean.clean_trips(t.trips(spark, d)), clean.clean_stays(t.stays(spark, d)))
    nights = F.col("NoNights") * F.col("SmoothedTripWeight")
    out = rows.select(
        "TripIDNumber", nights.cast("double").alias("Total_Nights"), F.lit(1).alias("Total_Respondents")
    )
    return out


def null_fill(spark, d):
    raw = t.trips(spark, d).where(F.col("TripIDNumber").isNotNull())
    filled = clean.clean_trips(raw).select("TripIDNumber", "POV", "ImputedSpendAccom", "ImputedSpendTrnsport")
    return _doubles(filled, "ImputedSpendAccom", "ImputedSpendTrnsport")


RULE_SETS = {
    "destination": DESTINATION_RULES,
    "spend": SPEND_TYPE_RULES,
    "activity": ACTIVITY_RULES,
    "accommodation": ACCOMMODATION_RULES,
    "purpose": PURPOSE_RULES,
    "class": ACTIVITY_CLASS_RULES,
}


def rule_inputs(name: str) -> list[str]:
    """Values a rule set applies to, and two near misses: trailing blanks and case decide."""
    old = list(RULE_SETS[name])
    return [*old, old[0] + " ", old[0].upper(), "unknown"]


def recode_values(spark, d):
    """Every rule set, on values that the order keys pick from its left sides."""
    orders, out = t.load(spark, d, "orders"), None
    for name, own in RULE_SETS.items():
        values = rule_inputs(name)
        value = F.element_at(F.array(*map(F.lit, values)), (F.col("o_orderkey") % len(values) + 1).cast("int"))
        part = orders.groupBy(F.lit(name).alias("rules"), recode(value, own).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


def los_band(spark, d):
    q = F.col("l_quantity")
    cases = F.array(
        F.struct(F.lit("eight").alias("source"), (8 * (q - 1)).alias("nights")),
        F.struct(F.lit("half").alias("source"), (q / 2).alias("nights")),
    )
    stacked = t.load(spark, d, "lineitem").select(F.inline(cases))
    band = length_of_stay_band(F.col("nights")).alias("band")
    return stacked.groupBy("source", band).agg(F.count(F.lit(1)).alias("n"))


def overnight_filter(spark, d):
    return clean.overnight_trips(t.trips(spark, d)).select("TripIDNumber", "TripType", "TripYear", "TripQtr")


# ------------------------------------------------------------------ joins


def trip_stay_join(spark, d):
    rows = accommodation_rows(t.trips(spark, d), t.stays(spark, d))
    out = rows.groupBy("Accommodation_Type").agg(
        F.sum("Total_Visitors").alias("Total_Visitors"),
        F.sum("Total_Trips").alias("Total_Trips"),
        F.sum("Total_Nights").alias("Total_Nights"),
        F.sum("Total_Respondents").alias("Total_Respondents"),
    )
    return _doubles(out, "Total_Visitors", "Total_Trips", "Total_Nights")


def activity_join(spark, d):
    rows = activity_rows(t.trips(spark, d), t.activities(spark, d))
    out = with_activity_groups(t.classification(spark, d))(rows).groupBy("Activity_Group").agg(
        F.sum("Total_Activities").alias("Total_Activities"), F.sum("Raw_Count").alias("n_rows")
    )
    return _doubles(out, "Total_Activities")


def ri_anti_join(spark, d):
    known = t.purposes(spark, t.PARTIAL_PURPOSES)
    cleaned = clean.clean_trips(t.trips(spark, d).select("POV"))
    unused = joins.unused_values(known, cleaned, "POV").select(F.lit("without trips").alias("side"), "POV")
    unknown = joins.unused_values(cleaned.distinct(), known, "POV")
    return unused.unionByName(unknown.select(F.lit("without group").alias("side"), "POV"))


# ------------------------------------------------------------------ rolling years


def year_end_labels(spark, d):
    return rolling.with_year_ends(t.trips(spark, d).select("TripIDNumber", "TripYear", "TripQtr"))


def year_end_unpivot(spark, d):
    labelled = year_end_labels(spark, d).drop("TripYear", "TripQtr")
    return rolling.stack_year_ends(labelled)


def complete_years(spark, d):
    return rolling.complete_years(t.trips(spark, d))


def quarterly_base(spark, d):
    quarterly = rolling.quarterly_totals(trip_rows(t.trips(spark, d)), [c for c in TRIP_DIMS[1:] if c != "POV_Group"], TRIP_MEASURES)
    out = rolling.with_year_ends(with_group(t.purposes(spark))(quarterly)).drop("TripYear", "TripQtr")
    return _doubles(out, "Total_Visitors", "Total_Trips")


def rolling_year_base(spark, d):
    return _doubles(_base("trips", spark, d), "Total_Visitors", "Total_Trips")


def activity_base(spark, d):
    base = _base("activity", spark, d).withColumnRenamed("Year_Ending", "YE")
    return _doubles(base, "Total_Activities")


# ------------------------------------------------------------------ cubes


def partial_grouping_sets(spark, d):
    out = cube.partial_cube(_base("trips", spark, d), TRIP_DIMS, TRIP_MEASURES)
    return _doubles(out, *TRIP_MEASURES)


def cube_wide(spark, d):
    """Cube of eleven dimensions, some of them numbers, dates and flags."""
    orders = t.load(spark, d, "orders").withColumns({name: F.expr(sql) for name, sql in t.WIDE_SQL.items()})
    total = F.sum(F.col("o_totalprice").cast(t.MONEY)).alias("total")
    base = orders.groupBy(*t.WIDE_SQL).agg(total)
    return _doubles(cube.dimension_cube(base, list(t.WIDE_SQL), ["total"]), "total")


def grand_total(spark, d):
    return _doubles(cube.grand_total(_base("trips", spark, d), TRIP_DIMS, TRIP_MEASURES), *TRIP_MEASURES)


def grouping_count(spark, d):
    base = staging(spark)(_base("trips", spark, d), "base")
    counts = checks.grouping_count(cube.dimension_cube(base, TRIP_DIMS, TRIP_MEASURES, "level"), "level")
    return counts.withColumn("level", F.col("level").cast("bigint"))


# ------------------------------------------------------------------ totals of several extracts, and kept ones


def shared_cube_spend(spark, d):
    """The spend cube from a pass over the facts that serves all four extracts."""
    stage, survey = staging(spark), _survey(spark, d)
    shared = fact_pass(survey, SPECS, stage, strict=True)
    built = survey_extract("spend", SPECS["spend"], survey, stage, shared)
    return _doubles(built.cube, *SPECS["spend"].measure_codes)


LATE, WRONG = (1998, 3), (1996, 2)


def _corrected(name: str, spark: SparkSession, d: str) -> Extract:
    """An extract from kept totals: one quarter came late, another was wrong at first."""
    survey, stage = _survey(spark, d), staging(spark)
    quarter = F.struct("TripYear", "TripQtr")
    late, wrong = (F.struct(F.lit(y), F.lit(q)) for y, q in (LATE, WRONG))
    weight = F.when(quarter == wrong, 3 * F.col("SmoothedTripWeight")).otherwise(F.col("SmoothedTripWeight"))
    early = replace(survey, trips=survey.trips.where(quarter != late).withColumn("SmoothedTripWeight", weight.cast(t.MONEY)))
    store = TotalsStore(spark, f"{stage.folder}/store", [name])
    store.refresh(early)
    store.refresh(survey, [LATE, WRONG])
    return survey_extract(name, SPECS[name], survey, stage, store.facts())


def corrected_trips(spark, d):
    return _doubles(_corrected("trips", spark, d).base, "Total_Visitors", "Total_Trips")


def corrected_accommodation(spark, d):
    return _doubles(_corrected("accommodation", spark, d).cube, *SPECS["accommodation"].measure_codes)


# ------------------------------------------------------------------ spend


PAIR = [spend.ALCOHOL, spend.FOOD_AND_ALCOHOL]


def _wide(spark, d):
    return spend.weighted_types(
        clean.clean_trips(t.trips(spark, d)), clean.clean_spend(t.spend_lines(spark, d)), PAIR
    )


def spend_pivot(spark, d):
    wide = _wide(spark, d).withColumnRenamed(PAIR[1], "FoodAndAlcohol")
    return _doubles(wide, "Alcohol", "FoodAndAlcohol")


def net_component(spark, d):
    return _doubles(spend.net_component(_wide(spark, d)), spend.ALCOHOL, spend.FOOD)


def spend_unpivot(spark, d):
    return _doubles(spend.gather_types(spend.net_component(_wide(spark, d))), "Expenditure")


def spend_long(spark, d):
    combined = spend.combined_spend(
        clean.clean_trips(t.trips(spark, d)), clean.clean_spend(t.spend(spark, d)), fill=0
    )
    return _doubles(combined, "Expenditure")


# ------------------------------------------------------------------ dimensions


def year_end_lookup(spark, d):
    stacked = rolling.complete_years(t.trips(spark, d))
    return dimensions.year_end_lookup(stacked, "YE", staging(spark))


def _pov_lookup(spark, d):
    return dimensions.generated_lookup(clean.clean_trips(t.trips(spark, d).select("POV")), "POV", staging(spark))


def lookup_generated(spark, d):
    return _pov_lookup(spark, d)


def dim_hierarchy(spark, d):
    return dimensions.hierarchy(_pov_lookup(spark, d))


def lookup_publish(spark, d):
    return dimensions.published_lookup(_pov_lookup(spark, d))


def lookup_many(spark, d):
    """Generated lookup of a column with many members."""
    return dimensions.generated_lookup(_customers(spark, d), "member", staging(spark))


def hierarchy_many(spark, d):
    return dimensions.hierarchy(staging(spark)(lookup_many(spark, d), "lookup"))


def _customers(spark, d):
    return t.load(spark, d, "orders").select(F.concat(F.lit("Customer "), F.col("o_custkey")).alias("member"))


def encode_dimensions(spark, d):
    built = _extract("trips", spark, d)
    return _doubles(dimensions.encode_dimensions(built.cube, built.lookups), *TRIP_MEASURES)


def encode_loss(spark, d):
    built = _extract("accommodation", spark, d)
    lookups = {c: built.lookups[c] for c in ("LOS_Group", "Destination_RTO", "Accommodation_Type")}
    return dimensions.encoding_loss(built.cube, lookups)


def loss_accommodation(spark, d):
    """Totals of members without a code, as the production extract reports them."""
    return _doubles(_extract("accommodation", spark, d).losses, *SPECS["accommodation"].measure_codes)


def loss_purposes(spark, d):
    built = build_extract(
        SPECS["trips"], trip_rows(t.trips(spark, d)), staging(spark), supplied={"Destination_RTO": t.destinations(spark, d)},
        adjust=with_group(t.purposes(spark, t.PARTIAL_PURPOSES)), key="POV", known=t.purposes(spark, t.PARTIAL_PURPOSES),
    )
    return _doubles(built.losses, *TRIP_MEASURES)


def loss_activities(spark, d):
    classes = t.classification(spark, d).where("Activity_Group <> 'PROMO'")
    built = build_extract(
        SPECS["activity"], activity_rows(t.trips(spark, d), t.activities(spark, d)), staging(spark),
        adjust=with_activity_groups(classes), key="Activities", known=classes.withColumnRenamed("Activity", "Activities"),
    )
    return _doubles(built.losses, "Total_Activities")


def format_measures(spark, d):
    full = _extract("trips", spark, d).cube
    return full.select(
        *TRIP_DIMS,
        measure_text(F.col("Total_Trips")).alias("trips_0"),
        measure_text(F.col("Total_Visitors"), 2).alias("visitors_2"),
        measure_text(F.col("Total_Visitors").cast("double") / 4).alias("visitors_quarter_0"),
        measure_text(F.col("Total_Respondents")).alias("respondents_0"),
    )


# ------------------------------------------------------------------ checks


CONTROL_YEAR = "YESep2000"


def reconcile_totals(spark, d):
    """Control figures against the production extracts; the expected ones come from detail rows."""
    trips = clean.clean_trips(t.trips(spark, d))
    in_year = ((F.col("TripYear") == 1999) & (F.col("TripQtr") == 4)) | (
        (F.col("TripYear") == 2000) & (F.col("TripQtr") <= 3)
    )
    built, activity = _extract("trips", spark, d), _extract("activity", spark, d)

    def figure(rows: DataFrame, column: str = "SmoothedTripWeight") -> float:
        return float(rows.agg(F.sum(F.col(column).cast(t.MONEY))).first()[0] or 0)

    controls = [
        Control("Total_Trips", float(int(figure(trips.where(in_year & (F.col("TripType") == kind))))), {"Year_Ending": CONTROL_YEAR, "Trip_Type": kind})
        for kind in (clean.DAY, clean.OVERNIGHT)
    ]
    year = figure(trips.where(F.col("TripYear") == 2000))
    controls.append(Control("Total_Trips", year, {"Year_Ending": "YEDec2000"}, how="within"))
    controls.append(Control("Total_Respondents", 1.0, {"Year_Ending": CONTROL_YEAR}))
    found = built.reconcile(controls)
    breakdown = checks.reconcile_breakdowns(
        built.base.where(F.col("Year_Ending") == CONTROL_YEAR), "trip type against purpose", "Total_Trips", "Trip_Type", "POV_Group"
    )
    lines = float(t.load(spark, d, "lineitem").count())
    quarter = trips.where((F.col("TripYear") == 1998) & (F.col("TripQtr") == 3))
    with_activity = quarter.join(t.activities(spark, d), F.col("TripIDNumber") == F.col("TripID"), "left_semi")
    rows = activity.reconcile(
        [
            Control("Raw_Count", lines, of="quarterly"),
            Control("SmoothedTripWeight", figure(with_activity), {"TripYear": 1998, "TripQtr": 3}, "within", "trips_with_details"),
        ]
    )
    return found.unionByName(breakdown).unionByName(rows)


def distinct_trip_total(spark, d):
    quarter = t.trips(spark, d).where((F.col("TripYear") == 1998) & (F.col("TripQtr") == 3))
    with_activity = joins.trips_with(clean.clean_trips(quarter), t.activities(spark, d))
    return with_activity.agg(F.sum("SmoothedTripWeight").cast("double").alias("total"))


def null_audit(spark, d):
    return checks.null_audit(t.trips(spark, d))


def rule_zero_sum(spark, d):
    trips = clean.clean_trips(t.trips(spark, d))
    held = checks.zero_total(spend.day_trip_accommodation(trips), "accommodation spend of day trips")
    # the same rule on trips whose type is turned round has to fail
    turned = trips.withColumn("TripType", F.when(F.col("TripType") == clean.DAY, clean.OVERNIGHT).otherwise(clean.DAY))
    return held.unionByName(checks.zero_total(spend.day_trip_accommodation(turned), "accommodation spend of turned trips"))


# ------------------------------------------------------------------ calendars


def quarter_end_date(spark, d):
    return calendar.quarter_calendar(t.trips(spark, d))


def lagged_month_end(spark, d):
    from yearwheel.functions import lagged_month_end as lagged

    quarters = calendar.quarter_calendar(t.trips(spark, d))
    return quarters.select("QEDate", *[lagged(F.col("QEDate"), n).alias(f"less{n}m") for n in (3, 9)])


def whole_years_lag(spark, d):
    return calendar.whole_years(calendar.quarter_calendar(t.trips(spark, d)))


def component_quarters(spark, d):
    return calendar.component_quarters(whole_years_lag(spark, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        scan_trips, lookup_prebuilt, purpose_concordance, purpose_group, forward_fill,
        activity_classification, weighted_measures, null_fill, recode_values, los_band,
        overnight_filter, trip_stay_join, activity_join, activity_base, ri_anti_join,
        year_end_labels, year_end_unpivot, complete_years, quarterly_base, rolling_year_base,
        partial_grouping_sets, cube_wide, grand_total, grouping_count, spend_pivot, net_component,
        spend_unpivot, spend_long, year_end_lookup, lookup_generated, dim_hierarchy,
        lookup_publish, lookup_many, hierarchy_many, encode_dimensions, encode_loss,
        loss_accommodation, loss_purposes, loss_activities, format_measures, reconcile_totals,
        distinct_trip_total, null_audit, rule_zero_sum, quarter_end_date, lagged_month_end,
        whole_years_lag, component_quarters, shared_cube_spend, corrected_trips, corrected_accommodation,
    )
} | {f"cube_{n}": _cube_query(n) for n in SPECS} | {f"extract_{n}": _extract_query(n) for n in SPECS}
