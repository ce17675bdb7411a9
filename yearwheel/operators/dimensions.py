"""Dimension lookups, hierarchies and the replacement of text by codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearwheel.functions.periods import year_end_description, year_end_quarter, year_end_year
from yearwheel.functions.text import quoted
from yearwheel.operators.cube import ALL, dimension_cube
from yearwheel.operators.staging import Staging

DIMENSION = "Dimension"
MEMBER = "Member"
LOOKUP_COLUMNS = ["Code", "Description", "SortOrder"]


def dimension_members(
    base: DataFrame, dims: Sequence[str], year_end: str | None = None, stage: Staging | None = None
) -> DataFrame:
    """Coded members of several dimensions: Dimension, Member, Code, Description, SortOrder.

    One pass over ``base`` and one shuffle of distinct members serve all dimensions. Codes number
    the members in dictionary order, regardless of case, year-ends in time order; ``All`` is last.
    Members of any type are written as text. Numbering is distributed, see :func:`numbered`.
    """
    entries = [F.struct(F.lit(d).alias(DIMENSION), F.col(d).cast("string").alias(MEMBER)) for d in dims]
    members = (
        base.select(F.inline(F.array(*entries)))
        .where(F.col(MEMBER).isNotNull() & (F.col(MEMBER) != ALL))
        .distinct()
    )
    is_period = F.col(DIMENSION) == F.lit(year_end)
    period = F.when(is_period, year_end_year(F.col(MEMBER)) * 4 + year_end_quarter(F.col(MEMBER)))
    coded = numbered(members, DIMENSION, period, F.lower(MEMBER), F.col(MEMBER), "Code", stage)
    total = coded.groupBy(DIMENSION).agg((F.count(F.lit(1)) + 1).cast("int").alias("Code"))
    description = F.when(is_period, year_end_description(F.col(MEMBER))).otherwise(F.col(MEMBER))
    return (
        coded.withColumn("Description", description)
        .unionByName(total.withColumns({MEMBER: F.lit(ALL), "Description": F.lit(ALL)}))
        .select(DIMENSION, MEMBER, "Code", "Description", F.col("Code").alias("SortOrder"))
    )


def numbered(
    members: DataFrame, key: str, lead: Column, text: Column, last: Column, name: str, stage: Staging | None = None
) -> DataFrame:
    """Row numbers from 1 within each ``key``, in order of ``lead``, ``text`` and ``last``.

    All rows are range-partitioned by a sample, so tasks are even however alike the members of a key begin, and written
    in order with their partition and their place in it. A row's number is its place, less the key's first place in that
    partition, plus the key's rows in partitions before. Those counts, one row for each key and partition, are all that
    meets in a window. The rows are written because the sample decides the cuts: rows and counts must see the same ones.
    """
    stage = stage or Staging(members.sparkSession)
    order = [F.col(key), F.col("_lead"), F.col("_text"), F.col("_last")]
    rows = members.withColumns({"_lead": lead, "_text": text, "_last": last})
    # the lower bits of the id count the rows of a partition
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    parted = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(parted.select(*members.columns, F.spark_partition_id().alias("_part"), place.alias("_place")), f"places_{uuid4().hex}")
    counts = placed.groupBy(F.col(key).alias("_key"), F.col("_part").alias("_of")).agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    before = Window.partitionBy("_key").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("_key", "_of", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    met = (F.col("_part") == F.col("_of")) & F.col(key).eqNullSafe(F.col("_key"))
    return placed.join(shifts, met).withColumn(name, (F.col("_place") + F.col("_shift")).cast("int")).select(*members.columns, name)


def year_end_lookup(df: DataFrame, column: str, stage: Staging | None = None) -> DataFrame:
    """Code, Description, SortOrder and YE (the label in the data) of a year-end dimension."""
    members = dimension_members(df.where(F.length(column) == 9), [column], column, stage)
    return members.select(*LOOKUP_COLUMNS, F.col(MEMBER).alias("YE"))


def generated_lookup(df: DataFrame, column: str, stage: Staging | None = None) -> DataFrame:
    """Code, Description and SortOrder of any other dimension."""
    return dimension_members(df, [column], stage=stage).select(*LOOKUP_COLUMNS)


def hierarchy(lookup: DataFrame) -> DataFrame:
    """Parent (code of ``All``) and Child (each other code) of one lookup."""
    is_total = F.col("Description") == ALL
    # one row, so it joins by broadcast; a lookup without ``All`` gives pairs without a parent
    total = lookup.agg(F.max(F.when(is_total, F.col("Code"))).alias("Parent")).withColumn("_one", F.lit(1))
    children = lookup.where(~is_total).select(F.col("Code").alias("Child"), F.lit(1).alias("_one"))
    return children.join(total, "_one").select("Parent", "Child")


def published_lookup(lookup: DataFrame) -> DataFrame:
    """Lookup as written: quoted description, blank sort order, no label column."""
    return lookup.select(
        "Code", quoted(F.col("Description")).alias("Description"), F.lit("").alias("SortOrder")
    )


def encode_dimensions(
    facts: DataFrame, lookups: Mapping[str, DataFrame], on_unmatched: str = "drop"
) -> DataFrame:
    """Replace the text of each dimension by its code.

    ``lookups`` maps a dimension to its lookup, keyed by YE where it has that column and by
    Description otherwise. Rows without a code are dropped, or with ``on_unmatched="fail"`` raise an
    error where they are met. No broadcast is forced: lookups come from files or staged tables, so
    Spark knows their size and picks the join.
    """
    columns = facts.columns
    for dim, lookup in lookups.items():
        codes, code = _codes(lookup, dim), F.col(f"{dim}_code")
        if on_unmatched == "fail":
            unmatched = F.raise_error(F.concat(F.lit(f"no code for {dim} "), F.col(dim)))
            facts = facts.join(codes, dim, "left").withColumn(dim, F.coalesce(code, unmatched.cast("int")))
        else:
            facts = facts.join(codes, dim).withColumn(dim, code)
    return facts.select(*columns)


def coded_cube(
    base: DataFrame,
    lookups: Mapping[str, DataFrame],
    measures: Sequence[str],
    on_unmatched: str = "drop",
    follows: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """The cube of ``base`` with members replaced by codes, equal to :func:`encode_dimensions` of its cube.

    Members are encoded before they are combined: lookups are joined to the base, the cube adds up rows of integers, and
    no text passes its shuffles. Members without a code still count in the totals over their dimension, where they
    have the same value as in a cube of texts; their own rows go, or raise an error. A code may belong to one member
    only: see :func:`shared_codes`. ``lookups`` are keyed as for :func:`encode_dimensions`.
    """
    dims = list(lookups)
    coded, totals = base, {}
    for dim, lookup in lookups.items():
        code = F.col(f"{dim}_code")
        if on_unmatched == "fail":
            code = F.coalesce(code, F.raise_error(F.concat(F.lit(f"no code for {dim} "), F.col(dim))).cast("int"))
        coded = coded.join(_codes(lookup, dim), dim, "left").withColumn(dim, code).drop(f"{dim}_code")
        total = lookup.agg(F.max(F.when(F.col(_key(lookup)) == ALL, F.col("Code")))).scalar()
        if on_unmatched == "fail":
            total = F.coalesce(total, F.raise_error(F.lit(f"no code for {dim} {ALL}")).cast("int"))
        totals[dim] = total
    out = dimension_cube(coded, dims, measures, follows=follows, totals=totals)
    return out.dropna(subset=dims) if on_unmatched != "fail" else out


def shared_codes(lookup: DataFrame) -> DataFrame:
    """Codes that stand for more than one member; their rows would be added up if encoded before the cube."""
    return lookup.groupBy("Code").agg(F.count_distinct(_key(lookup)).alias("n")).where(F.col("n") > 1)


def encoding_loss(facts: DataFrame, lookups: Mapping[str, DataFrame]) -> DataFrame:
    """Rows before and after encoding and the rows each dimension alone would lose, in one pass."""
    missing = {}
    for dim, lookup in lookups.items():
        facts = facts.join(_codes(lookup, dim), dim, "left")
        missing[dim] = F.col(f"{dim}_code").isNull()
    any_missing = F.lit(False)
    for flag in missing.values():
        any_missing = any_missing | flag
    return facts.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(~any_missing).alias("rows_after"),
        *[F.count_if(flag).alias(f"lost_{dim}") for dim, flag in missing.items()],
    )


def repeated_members(lookup: DataFrame) -> DataFrame:
    """Members with more than one code; encoding would repeat their rows."""
    counts = lookup.groupBy(_key(lookup)).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") > 1)


def member_of(lookup: DataFrame) -> Column:
    """The column of a lookup that holds the member as it stands in the data."""
    return F.col(_key(lookup))


def _key(lookup: DataFrame) -> str:
    return "YE" if "YE" in lookup.columns else "Description"


def _codes(lookup: DataFrame, dim: str) -> DataFrame:
    return lookup.select(F.col(_key(lookup)).alias(dim), F.col("Code").alias(f"{dim}_code"))
