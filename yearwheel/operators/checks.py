"""Reconciliation and data-quality checks.

Every check is a DataFrame with the columns control, actual, expected and ok, so checks can be
stacked, stored and compared; :func:`require` turns failures into an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from yearwheel.operators.rolling import NULLS_SUFFIX


class CheckFailed(ValueError):
    """A check did not hold."""


def require(checks: DataFrame, shown: int = 20) -> None:
    """Raise :class:`CheckFailed` with the number of failed controls and the first of them by name.

    A null outcome counts as failed. The message names up to ``shown`` and says how many it leaves out.
    """
    failed = checks.where(~F.coalesce(F.col("ok"), F.lit(False)))
    first = failed.orderBy("control", "actual", "expected").limit(shown).collect()
    if first:
        _refuse(first, len(first) if len(first) < shown else failed.count())


def require_rows(checks: Sequence[Row]) -> None:
    """As :func:`require`, for checks that have been collected."""
    failed = sorted(r for r in checks if not r.ok)
    if failed:
        _refuse(failed, len(failed))


def _refuse(first: Sequence[Row], n: int) -> None:
    named = "; ".join(f"{r.control}: {r.actual} instead of {r.expected}" for r in first)
    more = f"; and {n - len(first)} more" if n > len(first) else ""
    raise CheckFailed(f"{n} failed: {named}{more}")


def _truncated(x: Column) -> Column:
    return F.when(x >= 0, F.floor(x)).otherwise(F.ceil(x))


def reconcile(
    df: DataFrame,
    control: str,
    total: Column,
    expected: float | DataFrame,
    how: str = "truncate",
    tolerance: float = 0.5,
) -> DataFrame:
    """Compare an aggregate of ``df`` with a control figure.

    ``expected`` is a number or a one-row, one-column DataFrame. ``how``: ``truncate`` drops the
    decimals of the aggregate first, ``round`` rounds it half to even, ``within`` allows an absolute
    difference below ``tolerance``.
    """
    compared = {"truncate": _truncated(total), "round": F.bround(total, 0), "within": total}[how]
    actual = df.agg(compared.cast("double").alias("actual"))
    if isinstance(expected, DataFrame):
        row = _side_by_side(actual, expected.toDF("expected"))
    else:
        row = actual.withColumn("expected", F.lit(expected).cast("double"))
    return _compared(row, control, tolerance if how == "within" else None)


def reconcile_breakdowns(
    df: DataFrame, control: str, measure: str, first: str, second: str, tolerance: float = 0.5
) -> DataFrame:
    """Compare the totals of two breakdowns of one measure."""

    def total(by: str) -> DataFrame:
        return df.groupBy(by).agg(F.sum(measure).alias("t")).agg(F.sum("t").cast("double"))

    row = _side_by_side(total(first).toDF("actual"), total(second).toDF("expected"))
    return _compared(row, control, tolerance)


def _side_by_side(actual: DataFrame, expected: DataFrame) -> DataFrame:
    # two one-row tables with one column each
    both = actual.unionByName(expected, allowMissingColumns=True)
    return both.agg(F.max("actual").alias("actual"), F.max("expected").cast("double").alias("expected"))


def _compared(row: DataFrame, control: str, tolerance: float | None) -> DataFrame:
    difference = F.abs(F.col("actual") - F.col("expected"))
    ok = difference == 0 if tolerance is None else difference < tolerance
    return row.select(F.lit(control).alias("control"), "actual", "expected", ok.alias("ok"))


def zero_total(total: DataFrame, control: str) -> DataFrame:
    """Check a one-row, one-column total against zero."""
    value = F.col(total.columns[0]).cast("double")
    return total.select(
        F.lit(control).alias("control"),
        value.alias("actual"),
        F.lit(0.0).alias("expected"),
        (value == 0).alias("ok"),
    )


def no_rows(df: DataFrame, control: str) -> DataFrame:
    """Check that the DataFrame is empty; ``actual`` is its number of rows."""
    return zero_total(df.agg(F.count(F.lit(1))), control)


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column, all columns in one pass: column_name, n_null."""
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "n_null")


def refuse_missing(
    totals: DataFrame, dims: Sequence[str], measures: Sequence[str], extra: Sequence[str] = ()
) -> DataFrame:
    """Totals unchanged, with the columns ``extra`` as they are, but an error for a missing dimension or a sum that skipped missing values.

    Expects the null counts of :func:`rolling.quarterly_totals`. The test rides on the job that
    uses the totals instead of being a job of its own.
    """

    at = F.concat_ws(", ", *[F.coalesce(d, F.lit("missing")) for d in dims])

    def fail(column: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"missing values in {column} at "), at))

    return totals.select(
        *[F.when(F.col(d).isNotNull(), F.col(d)).otherwise(fail(d)).alias(d) for d in dims],
        *[
            F.when(F.col(m + NULLS_SUFFIX) == 0, F.col(m)).otherwise(fail(m)).alias(m)
            for m in measures
        ],
        *extra,
    )


def grouping_count(cube: DataFrame, level: str) -> DataFrame:
    """Rows of each grouping set and the number of sets; at most 2^n rows."""
    per_set = cube.groupBy(level).agg(F.count(F.lit(1)).alias("n_rows"))
    # the number of sets is one row of its own, added to each
    sets = cube.agg(F.count_distinct(level).alias("n_sets")).withColumn("_one", F.lit(1))
    return per_set.withColumn("_one", F.lit(1)).join(sets, "_one").drop("_one")
