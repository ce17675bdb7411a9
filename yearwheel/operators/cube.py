"""All dimension combinations with an explicit total member."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL = "All"
LEVEL = "_level"


def grouping_combinations(dims: Sequence[str]) -> list[tuple[str, ...]]:
    """Proper, non-empty subsets of the dimensions: 2^n - 2 of them."""
    return [combo for size in range(1, len(dims)) for combo in combinations(dims, size)]


def _named_totals(
    grouped: DataFrame, dims: Sequence[str], measures: Sequence[str], level: str | None, totals: Mapping[str, Column] | None = None
) -> DataFrame:
    # The grouping id tells a total from a missing or literal value of the same text. Members are
    # text, as the total's name is; a number, date or flag is written as Spark casts it.
    n = len(dims)
    total = totals or dict.fromkeys(dims, F.lit(ALL))
    member = {d: F.col(d) if totals else F.col(d).cast("string") for d in dims}
    members = [
        F.when(F.col(LEVEL).bitwiseAND(1 << (n - 1 - i)) != 0, total[d]).otherwise(member[d]).alias(d) for i, d in enumerate(dims)
    ]
    extra = [F.col(LEVEL).alias(level)] if level else []
    return grouped.select(*members, *measures, *extra)


def dimension_cube(
    base: DataFrame,
    dims: Sequence[str],
    measures: Sequence[str],
    level: str | None = None,
    step: int = 3,
    follows: Sequence[tuple[str, str]] = (),
    totals: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Sums for every subset of ``dims``; dimensions summed over read ``All``.

    ``base`` should already be aggregated: Spark multiplies its rows by 2^n before the map-side
    combine. Above ``step`` dimensions the cube is therefore taken over ``step`` of them at a time,
    each time from the totals so far. With six dimensions that multiplies the base by 8 and its
    much smaller outcome by 8 again, instead of the base by 64. ``level`` names an output column
    with the grouping id.

    ``follows`` are pairs of dimensions of which the first determines the second. A subset with the first
    but not the second then has the rows of the subset with both, under another name: these are not summed again but
    copied at the end. Each dimension may be in one pair; the pair goes in one step.

    ``totals`` gives the member that stands for the total of each dimension, where members are codes rather than
    texts; these then keep their type.
    """
    dims = list(dims)
    bit = {d: len(dims) - 1 - i for i, d in enumerate(dims)}
    sums = [F.sum(m).alias(m) for m in measures]
    column = {c: F.col(c) for c in [*dims, LEVEL]}
    current = base.select(*dims, *measures, F.lit(0).cast("bigint").alias(LEVEL))
    for part in _parts(dims, step, follows):
        fixed = [c for c in column if c not in part]
        subsets = [(), *grouping_combinations(part), tuple(part)]
        subsets = [s for s in subsets if not any(one in s and group not in s for one, group in follows)]
        sets = [[column[c] for c in (*fixed, *subset)] for subset in subsets]
        grouped = current.groupingSets(sets, *fixed, *part).agg(*sums, F.grouping_id().alias("_step"))
        reached = column[LEVEL]
        for i, d in enumerate(part):
            reached = reached + F.shiftleft(F.shiftright("_step", len(part) - 1 - i).bitwiseAND(1), bit[d])
        current = grouped.select(*dims, *measures, reached.alias(LEVEL))
    for one, group in follows:
        own = (1 << bit[one]) | (1 << bit[group])
        both = F.array(column[LEVEL], column[LEVEL] + (1 << bit[group]))
        named = F.when(column[LEVEL].bitwiseAND(own) == 0, both).otherwise(F.array(column[LEVEL]))
        current = current.select(*dims, *measures, F.explode(named).alias(LEVEL))
    return _named_totals(current, dims, measures, level, totals)


def _parts(dims: list[str], step: int, follows: Sequence[tuple[str, str]]) -> list[list[str]]:
    """Dimensions by steps, in order, those of a pair in the same one."""
    group_of = dict(follows)
    dependent = set(group_of.values())
    units = [[d, *([group_of[d]] if d in group_of else [])] for d in dims if d not in dependent]
    parts: list[list[str]] = []
    for unit in units:
        if parts and len(parts[-1]) + len(unit) <= step:
            parts[-1] += unit
        else:
            parts.append(list(unit))
    return parts


def partial_cube(
    base: DataFrame, dims: Sequence[str], measures: Sequence[str], level: str | None = None
) -> DataFrame:
    """The cube without its finest level and without the grand total, taken in the same steps."""
    inner = level or LEVEL
    full = dimension_cube(base, dims, measures, inner)
    # of one dimension alone nothing lies between the two
    proper = full.where((F.col(inner) != 0) & (F.col(inner) != (1 << len(dims)) - 1))
    return proper if level else proper.drop(inner)


def grand_total(base: DataFrame, dims: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row: every dimension ``All``. No row for an empty base, as in the cube."""
    row = base.agg(*[F.sum(m).alias(m) for m in measures], F.count(F.lit(1)).alias(LEVEL))
    return row.where(F.col(LEVEL) > 0).select(*[F.lit(ALL).alias(d) for d in dims], *measures)
