"""Forward fill of a sparse column along integer row positions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = "_block"
CARRY = "_carry"


def forward_fill(
    df: DataFrame,
    value: str,
    position: str,
    partition_by: Sequence[str] = (),
    *,
    span: int = 65536,
    levels: int = 2,
) -> DataFrame:
    """Replace nulls in ``value`` by the last value at a smaller ``position``.

    Positions are integers, unique within a partition key; a null key is a key of its own. A row
    without a position stands nowhere: it keeps its value, and fills no other row. Every row comes out
    once, and ``levels`` does not change the outcome.

    Rows are cut into blocks of ``span`` positions, so no task ever holds more than ``span`` rows of one
    key, however many the key has. The last value of each block is carried into the following blocks
    by the same method, one level up; after ``levels`` of it a window over what is left (1 /
    span^levels of the positions; with the defaults, positions up to 2^48 leave at most ``span`` rows).
    """
    placed = df.where(F.col(position).isNotNull())
    filled = _filled(placed, value, position, list(partition_by), span, levels, 0)
    return filled.unionByName(df.where(F.col(position).isNull()))


def _filled(
    df: DataFrame, value: str, position: str, keys: list[str], span: int, levels: int, last_row: int
) -> DataFrame:
    # last_row: 0 lets a row see its own value, -1 only those before it
    def last_seen(*partition: str):
        window = Window.partitionBy(*(partition or (F.lit(0),))).orderBy(position)
        return F.last(value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, last_row))

    if levels == 0:
        return df.withColumn(value, last_seen(*keys))

    block, carry = f"{BLOCK}{levels}", f"{CARRY}{levels}"
    blocked = df.withColumn(block, F.expr(f"`{position}` div {span}"))
    at = F.when(F.col(value).isNotNull(), F.col(position))
    ends = blocked.groupBy(*keys, block).agg(F.max_by(F.col(value), at).alias(carry))
    carried = _filled(ends, carry, block, keys, span, levels - 1, -1)
    carried = carried.toDF(*[f"_of_{c}" for c in carried.columns])
    same = reduce(and_, [F.col(f"`{c}`").eqNullSafe(F.col(f"`_of_{c}`")) for c in [*keys, block]])
    return (
        blocked.withColumn(value, last_seen(*keys, block))
        .join(carried, same)
        .withColumn(value, F.coalesce(value, f"_of_{carry}"))
        .select(*df.columns)
    )
