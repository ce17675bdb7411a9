"""The four extracts: fact rows for each, and the common path from rows to star schema."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace
from functools import cached_property, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from yearwheel.functions.text import measure_text
from yearwheel.operators import checks, clean, cube, dimensions, joins, rolling, spend
from yearwheel.operators.staging import Staging
from yearwheel.plans import facts
from yearwheel.plans.spec import Dimension, ExtractSpec, Measure
from yearwheel.sources.tables import SurveyTables

Adjustment = Callable[[DataFrame], DataFrame]

YEAR_COLUMNS = [rolling.YEAR, rolling.QUARTER]
_SURVEY = ("accommodation", "trips", "spend", "activity")
SEEN = "_quarters"

# Codes and titles of the published dimensions and measures.
YEAR_ENDING = Dimension("Year_Ending", "Year ending", "year_end")
LENGTH_OF_STAY = Dimension("LOS_Group", "Length of stay", "supplied")
DESTINATION = Dimension("Destination_RTO", "Regional tourism organisation", "supplied")
ACCOMMODATION_TYPE = Dimension("Accommodation_Type", "Accommodation type", "supplied")
TRIP_TYPE = Dimension("Trip_Type", "Trip type")
PURPOSE = Dimension("POV", "Purpose of visit")
PURPOSE_GROUP = Dimension("POV_Group", "Purpose of visit group")
SPEND_TYPE = Dimension("Spend_Type", "Spend type")
ACTIVITY_GROUP = Dimension("Activity_Group", "Activity group")
VISITORS = Measure("Total_Visitors", "Total visitors")
TRIPS = Measure("Total_Trips", "Total trips")
NIGHTS = Measure("Total_Nights", "Total nights")
RESPONDENTS = Measure("Total_Respondents", "Total respondents")
EXPENDITURE = Measure("Expenditure", "Expenditure", decimals=2)
ACTIVITIES = Measure("Total_Activities", "Total activities")


def extract_specs(survey: str) -> dict[str, ExtractSpec]:
    """Specifications of the four extracts; ``survey`` is the name the table titles start with."""
    trip_dims = (YEAR_ENDING, DESTINATION, TRIP_TYPE, PURPOSE, PURPOSE_GROUP)
    group = ((PURPOSE.code, PURPOSE_GROUP.code),)
    return {
        "accommodation": ExtractSpec(
            "7578",
            f"{survey}: Accommodation",
            (YEAR_ENDING, LENGTH_OF_STAY, DESTINATION, ACCOMMODATION_TYPE),
            (VISITORS, TRIPS, NIGHTS, RESPONDENTS),
            on_unmatched="drop",
        ),
        "trips": ExtractSpec("7579", f"{survey}: Trips", trip_dims, (VISITORS, TRIPS, RESPONDENTS), follows=group),
        "spend": ExtractSpec(
            "7580",
            f"{survey}: Visitor Spend",
            (*trip_dims, SPEND_TYPE),
            (EXPENDITURE,),
            breakdowns=(("Spend_Type", "POV_Group"),),
            follows=group,
        ),
        "activity": ExtractSpec(
            "7581",
            f"{survey}: Activities",
            (YEAR_ENDING, ACTIVITY_GROUP),
            (ACTIVITIES,),
            row_count="Raw_Count",
        ),
    }


def accommodation_rows(trips: DataFrame, stays: DataFrame) -> DataFrame:
    """Overnight trips x their stays, those of one type and band as one row with the measures of all.

    The trip's weights count once per stay. Stays are totalled before the join, so a trip with very many is a few rows.
    """
    overnight = clean.clean_trips(clean.overnight_trips(trips))
    weight, n = F.col("SmoothedTripWeight"), F.col("n")
    return joins.with_details(overnight, facts.stays_by_trip(stays)).select(
        *YEAR_COLUMNS,
        "LOS_Group",
        F.col("DestinationRTO").alias("Destination_RTO"),
        F.col("AccommodationType").alias("Accommodation_Type"),
        (F.col("RespondentWeight") * n).alias("Total_Visitors"),
        (weight * n).alias("Total_Trips"),
        (F.col("nights") * weight).alias("Total_Nights"),
        n.alias("Total_Respondents"),
    )


def trip_rows(trips: DataFrame) -> DataFrame:
    """Trips; their purpose group is added to the totals, see :func:`with_group`."""
    return clean.clean_trips(trips).select(
        *YEAR_COLUMNS,
        F.col("DestinationRTO").alias("Destination_RTO"),
        F.col("TripType").alias("Trip_Type"),
        "POV",
        F.col("RespondentWeight").alias("Total_Visitors"),
        F.col("SmoothedTripWeight").alias("Total_Trips"),
        F.lit(1).alias("Total_Respondents"),
    )


def with_group(purposes: DataFrame) -> Adjustment:
    """Purpose groups on quarterly totals.

    The group follows from the purpose, a dimension, so the join and its filter give the same
    outcome after the aggregation, on far fewer rows and with one grouping key less.
    """
    return lambda quarterly: joins.with_purpose_group(quarterly, purposes)


def net_with_group(purposes: DataFrame) -> Adjustment:
    """Purpose groups, and food net of alcohol, on quarterly totals."""
    return lambda quarterly: spend.net_totals(
        joins.with_purpose_group(quarterly, purposes), kind="Spend_Type"
    )


def activity_rows(trips: DataFrame, activities: DataFrame) -> DataFrame:
    """Trips x activities, mentions of one activity as one row. The trip's weight counts once per mention.

    Groups join the totals; ``Raw_Count`` is the number of mentions.
    """
    weights = clean.clean_trips(trips.select("TripIDNumber", *YEAR_COLUMNS, "SmoothedTripWeight"))
    return joins.with_details(weights, facts.activities_by_trip(activities)).select(
        *YEAR_COLUMNS, "Activities", (F.col("SmoothedTripWeight") * F.col("n")).alias("Total_Activities"), F.col("n").alias(facts.ROWS)
    )


def with_activity_groups(classification: DataFrame) -> Adjustment:
    """Activity groups on quarterly totals: the group follows from the activity."""

    def adjust(quarterly: DataFrame) -> DataFrame:
        matched = quarterly.join(classification, quarterly["Activities"] == classification["Activity"])
        return matched.drop("Activities", "Activity")

    return adjust


@dataclass(frozen=True)
class Control:
    """A known total: the measure over the members named, compared as in ``checks.reconcile``.

    ``of`` says which table is summed: the ``base`` (complete years by dimension, with the row count
    of the specification), the ``quarterly`` totals of all input rows, before any of them can leave for want
    of a group, or the ``trips_with_details``, trips that own a detail row, each once. The latter two have
    the columns TripYear and TripQtr.
    """

    measure: str
    expected: float
    members: Mapping[str, str | int] = field(default_factory=dict)
    how: str = "truncate"
    of: str = "base"


def _all_equal(members: Mapping[str, str | int]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(d) == m for d, m in members.items()])


@dataclass(frozen=True)
class Extract:
    """A built extract. Its quarterly totals and rolling years are staged; the rest is made when first asked for."""

    spec: ExtractSpec
    base: DataFrame
    quarterly: DataFrame
    supplied: Mapping[str, DataFrame]
    stage: Staging
    follows: tuple[tuple[str, str], ...] = ()
    key: str = ""
    known: DataFrame | None = None
    trips_with_details: DataFrame | None = None
    shared_codes: bool = False

    @cached_property
    def cube(self) -> DataFrame:
        return cube.dimension_cube(self.base, self.spec.dims, self.spec.measure_codes, follows=self.follows)

    @cached_property
    def lookups(self) -> dict[str, DataFrame]:
        return _lookups(self.spec, self.base, self.supplied, self.stage)

    @cached_property
    def data(self) -> DataFrame:
        text = [measure_text(F.col(m.code), m.decimals).alias(m.code) for m in self.spec.measures]
        spec = self.spec
        lookups = {d: self.lookups[d] for d in spec.dims}
        if self.shared_codes:
            return dimensions.encode_dimensions(self.cube.select(*spec.dims, *text), lookups, spec.on_unmatched)
        coded = dimensions.coded_cube(self.base, lookups, spec.measure_codes, spec.on_unmatched, self.follows)
        return coded.select(*spec.dims, *text)

    @cached_property
    def losses(self) -> DataFrame:
        """Totals of values that found no group, and of members without a code."""
        measures = self.spec.measure_codes
        lost = [
            joins.unmatched(self.base, self.supplied[d.code].withColumnRenamed("Description", d.code), d.code, measures)
            for d in self.spec.dimensions
            if d.lookup == "supplied"
        ]
        if self.known is not None:
            lost.append(joins.unmatched(self.quarterly, self.known, self.key, measures))
        if lost:
            return reduce(DataFrame.unionByName, lost)
        return self.base.select(F.lit("").alias("dimension"), F.lit("").alias("member"), *measures).limit(0)

    def tables(self) -> dict[str, DataFrame]:
        """All files of the bundle: data, lookups, hierarchies, then the three indexes."""
        spec = self.spec
        out = {spec.file_name("Data"): self.data}
        for dim in spec.dims:
            out[spec.file_name("DimenLookup", dim)] = dimensions.published_lookup(self.lookups[dim])
        for dim in spec.dims:
            out[spec.file_name("DimenHierarchy", dim)] = dimensions.hierarchy(self.lookups[dim])
        return out | self._indexes()

    def reconcile(self, controls: Iterable[Control]) -> DataFrame:
        """Compare totals with control figures known from elsewhere."""
        sources = {"base": self.base, "quarterly": self.quarterly, "trips_with_details": self.trips_with_details}
        found = []
        for c in controls:
            source = sources.get(c.of)
            if source is None:
                raise ValueError(f"extract {self.spec.table_id} has no table {c.of} to compare with controls")
            named = [c.measure, *([] if c.of == "base" else [f"of {c.of}"]), *map(str, c.members.values())]
            rows = source.where(_all_equal(c.members)) if c.members else source
            found.append(checks.reconcile(rows, " ".join(named), F.sum(c.measure), c.expected, c.how))
        return reduce(DataFrame.unionByName, found)

    def breakdown_checks(self) -> DataFrame | None:
        """The breakdowns that the specification wants to agree, over complete years."""
        first = self.spec.measure_codes[0]
        found = [
            checks.reconcile_breakdowns(self.base, f"{first} by {a} against {b}", first, a, b)
            for a, b in self.spec.breakdowns
        ]
        return reduce(DataFrame.unionByName, found) if found else None

    def _indexes(self) -> dict[str, DataFrame]:
        spec, spark = self.spec, self.data.sparkSession

        def index(kind: str, entries) -> DataFrame:
            code = [f'"{e.code}"' for e in entries]
            title = [f'"{e.title}"' for e in entries]
            return spark.createDataFrame(pa.table({f"{kind}Code": code, f"{kind}Title": title}))

        file_row = {
            "TableID": [spec.table_id],
            "TableCode": [spec.code],
            "TableTitle": [spec.title],
            "TableFileName": [""],
            "TableURL": [""],
        }
        return {
            "DimensionIndex": index("Dimension", spec.dimensions),
            "MeasureIndex": index("Measure", spec.measures),
            "FileIndex": spark.createDataFrame(pa.table(file_row)),
        }


def build_extract(
    spec: ExtractSpec,
    rows: DataFrame | None,
    stage: Staging,
    *,
    quarterly: DataFrame | None = None,
    rolled: DataFrame | None = None,
    supplied: Mapping[str, DataFrame] | None = None,
    quarters: DataFrame | None = None,
    adjust: Adjustment | None = None,
    key: str = "",
    known: DataFrame | None = None,
) -> Extract:
    """From fact rows, or their quarterly totals, to the star schema.

    ``rows`` holds year, quarter, the dimensions and the measures. It is read once, into staged
    rolling-year totals; everything after grows with the number of dimension combinations, not with
    the rows. ``quarterly`` stands for them where a pass over the facts has totalled them already, and ``rolled`` for the
    rolling years of these where a store keeps them. ``adjust`` works
    on the quarterly totals of the rows and adds the dimensions that
    follow from others, which the rows then need not have. ``supplied`` are the lookups the specification
    expects from outside; ``quarters`` is the table whose quarters decide which years are complete, the rows
    themselves by default. ``key`` is the column ``adjust`` joins by and ``known`` the table of its known
    values. Totals of unknown values, and of members without a code, are the extract's ``losses``.
    """
    details, measures = spec.detail_dims, spec.measure_codes
    extra = [spec.row_count] if spec.row_count else []
    if quarterly is None:
        found = [c for c in rows.columns if c in details or (key and c == key)]
        # rows that stand for several say for how many
        counted = [c for c in extra if c in rows.columns]
        number = spec.row_count if extra and not counted else None
        quarterly = rolling.quarterly_totals(rows, found, [*measures, *counted], rows=number, count_nulls=True)
        quarterly = quarterly.drop(*[c + rolling.NULLS_SUFFIX for c in counted])
        if adjust is not None:
            # everything that is joined to the totals, or counted as lost there, reads them from here
            quarterly = stage(quarterly, f"quarters{spec.table_id}")
    carried = [*measures, *extra, *(m + rolling.NULLS_SUFFIX for m in measures)]
    if rolled is None:
        adjusted = quarterly if adjust is None else adjust(quarterly)
        totals = rolling.rolling_year_totals(adjusted, details, carried, seen=SEEN)
    else:
        # adjusting is linear and works by dimensions, so it may follow the sum over quarters
        adjusted = rolled if adjust is None else adjust(rolled)
        totals = adjusted.groupBy(rolling.YEAR_END, *details).agg(*[F.sum(c).alias(c) for c in carried], F.bit_or(SEEN).alias(SEEN))
    totals = stage(totals, f"totals{spec.table_id}")
    if quarters is None:
        complete = rolling.years_seen_whole(totals, SEEN)
    else:
        complete = rolling.complete_years(quarters)
    base = totals.join(complete, rolling.YEAR_END, "left_semi")
    base = base.withColumnRenamed(rolling.YEAR_END, spec.year_dim)
    base = checks.refuse_missing(base, spec.dims, measures, extra)
    follows, shared = _judged(spec, totals, supplied or {})
    return Extract(spec, base, quarterly, supplied or {}, stage, follows, key, known, shared_codes=shared)


def _judged(
    spec: ExtractSpec, totals: DataFrame, supplied: Mapping[str, DataFrame]
) -> tuple[tuple[tuple[str, str], ...], bool]:
    """The declared dependencies that hold, and whether a code of a supplied lookup stands for several members.

    Refuses supplied members with several codes. One job for all.

    A member with two codes would repeat its rows, whether unknown members are dropped or refused. A member that
    stands below two others is summed with its group like any other pair of dimensions.
    """
    coded = [d.code for d in spec.dimensions if d.lookup == "supplied"]
    found = [supplied[c].select(F.lit(c).alias("dim"), dimensions.member_of(supplied[c]).alias("member"), F.lit(None).cast("string").alias("group")) for c in coded]
    found += [totals.select(F.lit(f"{one} {group}").alias("dim"), F.col(one).alias("member"), F.col(group).alias("group")) for one, group in spec.follows]
    if not found:
        return (), False
    # codes are looked at like members of a dimension whose group is the member
    found += [supplied[c].select(F.lit(f"{c} Code").alias("dim"), F.col("Code").cast("string").alias("member"), dimensions.member_of(supplied[c]).alias("group")) for c in coded]
    rows = reduce(DataFrame.unionByName, found).groupBy("dim", "member").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("group").alias("groups"))
    several = F.when(F.col("dim").isin(coded), F.col("n") > 1).otherwise(F.col("groups") > 1)
    counts = {r.dim: r.n for r in rows.where(several).groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    checks.require_rows([Row(control=f"members of {c} with several codes", actual=float(counts.get(c, 0)), expected=0.0, ok=c not in counts) for c in coded])
    follows = tuple(pair for pair in spec.follows if " ".join(pair) not in counts)
    return follows, any(f"{c} Code" in counts for c in coded)


def _lookups(
    spec: ExtractSpec, base: DataFrame, supplied: Mapping[str, DataFrame], stage: Staging
) -> dict[str, DataFrame]:
    coded = [d.code for d in spec.dimensions if d.lookup != "supplied"]
    members = dimensions.dimension_members(base, coded, spec.year_dim, stage)
    members = stage(members, f"members{spec.table_id}")
    out = {}
    for dim in spec.dimensions:
        if dim.lookup == "supplied":
            out[dim.code] = supplied[dim.code]
            continue
        own = members.where(F.col(dimensions.DIMENSION) == dim.code)
        if dim.lookup == "year_end":
            own = own.withColumnRenamed(dimensions.MEMBER, "YE")
        out[dim.code] = own.select(*dimensions.LOOKUP_COLUMNS, *(["YE"] if dim.lookup == "year_end" else []))
    return out


def survey_extract(
    name: str, spec: ExtractSpec, tables: SurveyTables, stage: Staging, shared: facts.Facts | None = None
) -> Extract:
    """Build one of the extracts of :func:`extract_specs` from the survey tables.

    ``shared`` holds the totals of a pass over the facts that serves other extracts too; without it the extract makes
    its own.
    """
    if name not in _SURVEY:
        raise ValueError(f"unknown extract {name}")
    if shared is None:
        shared = facts.fact_pass(tables, [name], stage)
    supplied = {
        "Destination_RTO": tables.destinations,
        "LOS_Group": tables.lengths_of_stay,
        "Accommodation_Type": tables.accommodation_types,
    }
    options = {"quarterly": shared.quarterly[name], "supplied": {d: t for d, t in supplied.items() if d in spec.dims}}
    if shared.rolled is not None:
        options |= {"rolled": shared.rolled[name]}
    details = None
    if name == "accommodation":
        # years are judged by the overnight trips, with or without a recorded stay
        options |= {"quarters": shared.overnight_quarters}
        details = tables.stays
    elif name == "trips":
        options |= {"adjust": with_group(tables.purposes), "key": "POV", "known": tables.purposes}
    elif name == "spend":
        options |= {"adjust": net_with_group(tables.purposes), "key": "POV", "known": tables.purposes}
        details = tables.spend
    else:
        classes = stage(tables.classification, f"classes{spec.table_id}")
        known = classes.withColumnRenamed("Activity", "Activities")
        options |= {"adjust": with_activity_groups(classes), "key": "Activities", "known": known}
        details = tables.activities
    built = build_extract(spec, None, stage, **options)
    if details is None:
        return built
    return replace(built, trips_with_details=joins.trips_with(clean.clean_trips(tables.trips), details))


def purposes_unused(tables: SurveyTables, extract: Extract) -> DataFrame:
    """Check that all purposes of the concordance occur, from the staged totals."""
    unused = joins.unused_values(tables.purposes, extract.quarterly, "POV")
    return checks.no_rows(unused, "purposes without trips")


def input_checks(name: str, tables: SurveyTables) -> DataFrame | None:
    """Checks of an extract's input tables that its totals cannot answer; each reads a few columns.

    Day trips have no accommodation spend; trips have alcohol and food with alcohol exactly once each, or
    neither.
    """
    if name != "spend":
        return None
    total = spend.day_trip_accommodation(clean.clean_trips(tables.trips))
    uneven = spend.uneven_types(
        clean.clean_spend(tables.spend), [spend.ALCOHOL, spend.FOOD_AND_ALCOHOL], key="TripID"
    )
    found = checks.zero_total(total, "accommodation spend of day trips")
    return found.unionByName(checks.no_rows(uneven, "trips without exactly one row per food type"))
