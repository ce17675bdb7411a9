"""One pass over the fact tables for any number of extracts.

Details are totalled by trip first: stays by type and band, spend by type, activities by label. A trip with
very many details is a few entries by then, whether tables are bucketed by trip or not, and the totals
by trip are combined in the map stage. Each trip meets the lists of its entries once, says what it adds
to each extract, and one aggregation by extract, quarter and dimensions gives the quarterly totals of all of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType

from yearwheel.operators import checks, clean, joins, rolling, spend
from yearwheel.operators.staging import Staging
from yearwheel.sources.tables import SurveyTables

TAG = "extract"
# quarters of overnight trips, with or without a stay, and what the rules on spend found
OVERNIGHT_QUARTERS = "overnight"
SPEND_RULES = "rules"
ROWS = "Raw_Count"

DIMENSIONS = {
    "accommodation": ["LOS_Group", "Destination_RTO", "Accommodation_Type"],
    "trips": ["Destination_RTO", "Trip_Type", "POV"],
    "spend": ["Destination_RTO", "Trip_Type", "POV", "Spend_Type"],
    "activity": ["Activities"],
    OVERNIGHT_QUARTERS: [],
    SPEND_RULES: [],
}
MEASURES = {
    "accommodation": ["Total_Visitors", "Total_Trips", "Total_Nights", "Total_Respondents"],
    "trips": ["Total_Visitors", "Total_Trips", "Total_Respondents"],
    "spend": ["Expenditure"],
    "activity": ["Total_Activities", ROWS],
    OVERNIGHT_QUARTERS: ["n_trips"],
    SPEND_RULES: ["uneven", "day_accommodation"],
}
ENTRIES = "_entries"


def stays_by_trip(stays: DataFrame) -> DataFrame:
    """Number of stays and nights by trip, type and band."""
    return clean.clean_stays(stays).groupBy("TripID", "AccommodationType", "LOS_Group").agg(
        F.count(F.lit(1)).alias("n"), F.sum("NoNights").alias("nights")
    )


def spend_by_trip(spending: DataFrame) -> DataFrame:
    """Rows and amount by trip and type; the amount is missing if that of any row is."""
    missing = F.count_if(F.col("ImputedSpendAmt").isNull()) > 0
    return clean.clean_spend(spending).groupBy("TripID", "SpendType").agg(
        F.count(F.lit(1)).alias("n"), F.when(~missing, F.sum("ImputedSpendAmt")).alias("Amount")
    )


def activities_by_trip(activities: DataFrame) -> DataFrame:
    """Number of mentions by trip and activity."""
    return clean.clean_activities(activities).groupBy("TripID", "Activities").agg(F.count(F.lit(1)).alias("n"))


_DETAILS = {"accommodation": ("stays", stays_by_trip), "spend": ("spend", spend_by_trip), "activity": ("activities", activities_by_trip)}


# What a trip adds to an extract is an entry: the number of its tag, up to two names, rows, nights and an amount. All
# lists of entries have this one type, so that a trip's lists are only put one after the other, and whatever follows from the
# trip's own columns is worked out by compiled expressions on the rows made of them.
TAGS = list(MEASURES)
NAMES = {"accommodation": ("LOS_Group", "AccommodationType"), "spend": ("SpendType",), "activity": ("Activities",)}


def _entry(tag: str, kinds: Mapping[str, DataType], **values: Column | str) -> Column:
    cells = {"tag": F.lit(TAGS.index(tag)), "first": F.lit(None), "second": F.lit(None), "n": F.lit(None), "nights": F.lit(None), "amount": F.lit(None)}
    cells |= {k: F.lit(v) if isinstance(v, str) else v for k, v in values.items()}
    types = {"tag": "int", "first": "string", "second": "string", "n": "long", **kinds}
    return F.struct(*[v.cast(types[k]).alias(k) for k, v in cells.items()])


def _listed(by_trip: DataFrame, name: str, apart: bool, kinds: Mapping[str, DataType]) -> DataFrame:
    """Trip and the list of its entries: as many as types, bands or labels a trip has; ``apart``, a list for each."""
    values = dict(zip(("first", "second"), map(F.col, NAMES[name]), strict=False)) | {"n": F.col("n")}
    values |= {k: F.col(c) for k, c in (("nights", "nights"), ("amount", "Amount")) if c in by_trip.columns}
    entry = _entry(name, kinds, **values)
    trip = F.col(joins.DETAIL_TRIP).alias(f"_{name}{ENTRIES}_trip")
    if apart:
        return by_trip.select(trip, F.array(entry).alias(f"{name}{ENTRIES}"))
    return by_trip.groupBy(trip).agg(F.collect_list(entry).alias(f"{name}{ENTRIES}"))


def with_entries(
    trips: DataFrame, tables: SurveyTables, names: Iterable[str], orphans: bool = False
) -> tuple[DataFrame, Mapping[str, DataType]]:
    """Trips with the list of each kind of detail in a column, and the types of nights and amounts in it.

    ``orphans`` keeps spend of unknown trips. A trip is one row, unless stays or activities alone are wanted: then it is a
    row for each entry, which saves making the lists and changes none of their totals.
    """
    names = list(names)
    apart = names in (["accommodation"], ["activity"])
    out = trips.withColumn("_known", F.lit(True))
    # spend last: its orphans have no key by which to look for other details
    details = {n: _DETAILS[n][1](getattr(tables, _DETAILS[n][0])) for n in sorted((n for n in names if n in _DETAILS), key=lambda n: n == "spend")}
    kinds: dict[str, DataType] = {"nights": LongType(), "amount": LongType()}
    for kind, name, column in (("nights", "accommodation", "nights"), ("amount", "spend", "Amount")):
        if name in details:
            kinds[kind] = details[name].schema[column].dataType
    for name, by_trip in details.items():
        listed = _listed(by_trip, name, apart, kinds)
        how = "full" if orphans and name == "spend" else "left"
        key = f"_{name}{ENTRIES}_trip"
        out = out.join(listed, out[joins.TRIP] == listed[key], how).drop(key)
    return out, kinds


def _day_accommodation() -> Column:
    return F.when(F.col("TripType") == clean.DAY, F.col("ExpenditureWeight") * F.col("ImputedSpendAccom"))


def _uneven(entries: Column) -> Column:
    """1 for a trip without exactly one row per food type."""
    rows = F.aggregate(
        entries,
        F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("f")),
        lambda s, e: F.struct(
            (s["a"] + F.when(e["first"] == spend.ALCOHOL, e["n"]).otherwise(0)).alias("a"),
            (s["f"] + F.when(e["first"] == spend.FOOD_AND_ALCOHOL, e["n"]).otherwise(0)).alias("f"),
        ),
    )
    return ((rows["a"] + rows["f"] > 0) & ((rows["a"] != 1) | (rows["f"] != 1))).cast("int")


def _lists(tags: list[str], kinds: Mapping[str, DataType]) -> list[Column]:
    """What a trip adds to the tags, as lists of entries."""

    def when(condition: Column, entries: Column) -> Column:
        return F.when(condition, entries).otherwise(F.slice(entries, 1, 0))

    known, overnight = F.coalesce(F.col("_known"), F.lit(False)), F.col("TripType") == clean.OVERNIGHT
    none = F.slice(F.array(_entry("trips", kinds)), 1, 0)
    found = []
    for tag in tags:
        details = F.coalesce(F.col(f"{tag}{ENTRIES}"), none) if tag in _DETAILS else none
        if tag == "accommodation":
            found.append(when(known & overnight, details))
        elif tag == "trips":
            found.append(when(known, F.array(_entry(tag, kinds))))
        elif tag == "spend":
            # entries without a number of rows are those derived from the trip
            both = [_entry(tag, kinds, first=kind) for kind in (spend.ACCOMMODATION, spend.TRANSPORT)]
            found += [when(known, details), when(known, F.when(overnight, F.array(*both)).otherwise(F.array(both[1])))]
        elif tag == "activity":
            found.append(when(known, details))
        elif tag == OVERNIGHT_QUARTERS:
            found.append(when(known & overnight, F.array(_entry(tag, kinds))))
        else:  # the rules are the only ones that see spend of unknown trips
            found.append(when((F.col("_uneven") > 0) | (_day_accommodation() != 0), F.array(_entry(tag, kinds))))
    return found


def _measures(tag: str) -> dict[str, Column]:
    """What an entry of a tag counts for."""
    n, weight = F.col("n"), F.col("SmoothedTripWeight")
    if tag == "accommodation":
        return {
            "Total_Visitors": F.col("RespondentWeight") * n, "Total_Trips": weight * n, "Total_Nights": F.col("nights") * weight, "Total_Respondents": n,
        }
    if tag == "trips":
        return {"Total_Visitors": F.col("RespondentWeight"), "Total_Trips": weight, "Total_Respondents": F.lit(1)}
    if tag == "spend":
        paid = F.col("ExpenditureWeight")
        accommodation = n.isNull() & (F.col("first") == spend.ACCOMMODATION)
        derived = F.when(accommodation, paid * F.col("ImputedSpendAccom")).when(n.isNull(), paid * F.col("ImputedSpendTrnsport"))
        return {"Expenditure": derived.otherwise(paid * F.col("amount"))}
    if tag == "activity":
        return {"Total_Activities": weight * n, ROWS: n}
    if tag == OVERNIGHT_QUARTERS:
        return {"n_trips": F.lit(1)}
    return {"uneven": F.col("_uneven"), "day_accommodation": _day_accommodation()}


# where the members of each dimension stand: in a column of the trip or in a name of the entry
MEMBERS = {
    "Destination_RTO": "DestinationRTO", "Trip_Type": "TripType", "POV": "POV",
    "LOS_Group": "first", "Accommodation_Type": "second", "Spend_Type": "first", "Activities": "first",
}


def _stacked(trips: DataFrame, tags: list[str], kinds: Mapping[str, DataType]) -> DataFrame:
    """A row for each entry of each tag, with the columns of all; measures carry their tag's name."""
    if SPEND_RULES in tags:
        entries = F.col(f"spend{ENTRIES}")
        trips = trips.withColumn("_uneven", F.when(entries.isNull(), F.lit(0)).otherwise(_uneven(entries)))
    own = [c for c in trips.columns if not c.endswith(ENTRIES)]
    rows = trips.select(*own, F.inline(F.concat(*_lists(tags, kinds))))
    number = {t: TAGS.index(t) for t in tags}
    name = F.element_at(F.array(*map(F.lit, TAGS)), F.col("tag") + 1)
    columns = {}
    for tag in tags:
        for d in DIMENSIONS[tag]:
            columns[d] = F.when(F.col("tag").isin([number[t] for t in tags if d in DIMENSIONS[t]]), F.col(MEMBERS[d])).alias(d)
        for m, value in _measures(tag).items():
            columns[f"{tag}:{m}"] = F.when(F.col("tag") == number[tag], value).alias(f"{tag}:{m}")
    return rows.select(name.alias(TAG), rolling.YEAR, rolling.QUARTER, *columns.values())


def _columns(names: Iterable[str]) -> list[str]:
    """Columns of the trips that the extracts read; others never reach a shuffle."""
    names = set(names)
    wanted = {joins.TRIP, rolling.YEAR, rolling.QUARTER}
    if names & {"accommodation", "trips", "spend"}:
        wanted |= {"TripType", "DestinationRTO"}
    if names & {"accommodation", "trips"}:
        wanted |= {"RespondentWeight", "SmoothedTripWeight"}
    if names & {"trips", "spend"}:
        wanted |= {"POV"}
    if "spend" in names:
        wanted |= {"ExpenditureWeight", "ImputedSpendAccom", "ImputedSpendTrnsport"}
    if "activity" in names:
        wanted |= {"SmoothedTripWeight"}
    return sorted(wanted)


@dataclass(frozen=True)
class Facts:
    """Quarterly totals by extract, and what else came out of the pass."""

    quarterly: Mapping[str, DataFrame]
    overnight_quarters: DataFrame | None
    spend_rules: DataFrame | None
    # rolling years of the quarterly totals, where a store keeps them
    rolled: Mapping[str, DataFrame] | None = None


def wanted_tags(names: Iterable[str], strict: bool = False) -> list[str]:
    """The extracts, each once, and what else the pass has to find for them."""
    names = list(dict.fromkeys(names))
    unknown = set(names) - set(MEASURES)
    if unknown:
        raise ValueError(f"unknown extract {', '.join(sorted(unknown))}")
    return [*names, *([OVERNIGHT_QUARTERS] if "accommodation" in names else []), *([SPEND_RULES] if strict and "spend" in names else [])]


def totalled(tables: SurveyTables, tags: list[str], quarters: Iterable[tuple[int, int]] | None = None) -> DataFrame:
    """Quarterly totals of all tags in one table: tag, quarter, dimensions and each tag's measures.

    ``quarters`` restricts the trips to some (year, quarter); the condition reaches their scan.
    """
    names, rules = [t for t in tags if t in _DETAILS or t == "trips"], SPEND_RULES in tags
    trips = tables.trips
    if quarters is not None:
        within = [(F.col(rolling.YEAR) == y) & (F.col(rolling.QUARTER) == q) for y, q in quarters]
        trips = trips.where(reduce(lambda a, b: a | b, within, F.lit(False)))
    if names == ["accommodation"]:
        trips = clean.overnight_trips(trips)
    trips = clean.clean_trips(trips.select(_columns(names)))
    listed, kinds = with_entries(trips, tables, names, orphans=rules)
    stacked = _stacked(listed, tags, kinds)
    dims = list(dict.fromkeys(d for t in tags for d in DIMENSIONS[t]))
    totals = []
    for tag in tags:
        for m in MEASURES[tag]:
            column = F.col(f"`{tag}:{m}`")
            totals.append(F.sum(column).alias(f"{tag}:{m}"))
            if tag in names and m != ROWS:
                totals.append(F.count_if((F.col(TAG) == tag) & column.isNull()).alias(f"{tag}:{m}{rolling.NULLS_SUFFIX}"))
    return stacked.groupBy(TAG, rolling.YEAR, rolling.QUARTER, *dims).agg(*totals)


def own_totals(totals: DataFrame, tag: str, keys: Iterable[str]) -> DataFrame:
    """The rows of one tag, with ``keys``, its dimensions and its measures under their own names."""
    own = [F.col(f"`{c}`").alias(c.split(":", 1)[1]) for c in totals.columns if c.startswith(f"{tag}:")]
    return totals.where(F.col(TAG) == tag).select(*keys, *DIMENSIONS[tag], *own)


def fact_pass(tables: SurveyTables, names: Iterable[str], stage: Staging, strict: bool = False) -> Facts:
    """Scan each fact table that the extracts need once and stage their quarterly totals.

    ``strict`` also judges the rules on spend in the same scan: the checks of ``extracts.input_checks``.
    """
    tags = wanted_tags(names, strict)
    return read_facts(stage(totalled(tables, tags), "quarters", by=[TAG]), tags)


def read_facts(staged: DataFrame, tags: list[str], rolled: Mapping[str, DataFrame] | None = None) -> Facts:
    """Facts from a table as :func:`totalled` makes it."""
    quarter = [rolling.YEAR, rolling.QUARTER]
    overnight = own_totals(staged, OVERNIGHT_QUARTERS, quarter).select(*quarter) if OVERNIGHT_QUARTERS in tags else None
    found = None
    if SPEND_RULES in tags:
        broken = own_totals(staged, SPEND_RULES, quarter)
        day = broken.agg(F.coalesce(F.sum("day_accommodation"), F.lit(0)).alias("total"))
        uneven = broken.agg(F.coalesce(F.sum("uneven"), F.lit(0)).alias("total"))
        found = checks.zero_total(day, "accommodation spend of day trips")
        found = found.unionByName(checks.zero_total(uneven, "trips without exactly one row per food type"))
    own = [t for t in tags if t not in (OVERNIGHT_QUARTERS, SPEND_RULES)]
    return Facts({n: own_totals(staged, n, quarter) for n in own}, overnight, found, rolled)
