"""Totals kept between runs, so that a new or corrected quarter costs that quarter and the years it enters.

Quarterly totals lie in a folder partitioned by extract, year and quarter, rolling years beside them by extract and
year-end. Refreshing a quarter reads its trips and replaces its partitions; then the four years that hold it
are summed again from at most seven quarters, and replace theirs. Other quarters and years are neither read nor written.
Purposes, classes and lookups are joined to the totals when an extract is built, so they may change without a refresh.

A quarter that has become empty must replace what it had: each refresh writes a row without totals for every extract and
quarter, which readers leave out.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearwheel.operators import rolling
from yearwheel.plans import facts
from yearwheel.sources.tables import SurveyTables

SEEN = "_quarters"
KEPT = "_kept"
NAMES = ("accommodation", "trips", "spend", "activity")


def years_of(quarters: Iterable[tuple[int, int]]) -> list[str]:
    """Year-ends that hold any of the quarters: four for each, in the labels of :mod:`functions.periods`."""
    return sorted({f"{label}{year if quarter <= last else year + 1}" for year, quarter in quarters for last, label in enumerate(rolling.LABELS, 1)})


class TotalsStore:
    """Quarterly and rolling totals of the extracts in one folder."""

    def __init__(self, spark: SparkSession, folder: str, names: Iterable[str] = NAMES):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.tags = facts.wanted_tags(names)
        self.names = [t for t in self.tags if t in NAMES]

    def _write(self, df: DataFrame, name: str, by: list[str], marks: DataFrame | None) -> None:
        kept = df.withColumn(KEPT, F.lit(True))
        if marks is not None:
            kept = kept.unionByName(marks.withColumn(KEPT, F.lit(False)), allowMissingColumns=True)
        mode = "dynamic" if marks is not None else "static"
        kept.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*by).parquet(f"{self.folder}/{name}")

    def _read(self, name: str) -> DataFrame:
        # marks have no totals; partitions come back with the types of their text
        return self.spark.read.parquet(f"{self.folder}/{name}").where(KEPT).drop(KEPT)

    def _marks(self, column: str, values: list) -> DataFrame:
        rows = [(tag, *(v if isinstance(v, tuple) else (v,))) for tag in self.tags for v in values]
        return self.spark.createDataFrame(rows, f"{facts.TAG} string, {column}")

    def refresh(self, tables: SurveyTables, quarters: Iterable[tuple[int, int]] | None = None) -> None:
        """Total the given (year, quarter) again from ``tables``, or everything if none are given.

        ``tables`` may hold all rows or those of the quarters only.
        """
        quarters = None if quarters is None else sorted(set(quarters))
        if quarters is not None and not quarters:
            return
        marks = None if quarters is None else self._marks("TripYear int, TripQtr int", quarters)
        totals = facts.totalled(tables, self.tags, quarters)
        totals = totals.withColumns({c: F.col(c).cast("int") for c in (rolling.YEAR, rolling.QUARTER)})
        self._write(totals, "quarters", [facts.TAG, rolling.YEAR, rolling.QUARTER], marks)
        self._roll(quarters)

    def _roll(self, quarters: list[tuple[int, int]] | None) -> None:
        found = self._read("quarters").where(F.col(facts.TAG).isin(self.names))
        marks = None
        if quarters is not None:
            years = years_of(quarters)
            # the years hold quarters up to three before or after the given ones; others are not opened
            at = [4 * y + q for y, q in quarters]
            near = sorted({k + d for k in at for d in range(-3, 4)})
            found = found.where((4 * F.col(rolling.YEAR) + F.col(rolling.QUARTER)).isin(near))
            marks = self._marks(f"{rolling.YEAR_END} string", years)
        dims = [c for c in found.columns if ":" not in c and c not in (rolling.YEAR, rolling.QUARTER)]
        measures = [c for c in found.columns if ":" in c]
        rolled = _rolled(found, dims, measures)
        if quarters is not None:
            rolled = rolled.where(F.col(rolling.YEAR_END).isin(years))
        self._write(rolled, "years", [facts.TAG, rolling.YEAR_END], marks)

    def facts(self) -> facts.Facts:
        """What :func:`plans.extracts.survey_extract` builds an extract from."""
        years = self._read("years")
        rolled = {n: facts.own_totals(years, n, [rolling.YEAR_END, SEEN]) for n in self.names}
        return facts.read_facts(self._read("quarters"), self.tags, rolled)


def _rolled(quarterly: DataFrame, dims: list[str], measures: list[str]) -> DataFrame:
    """Rolling totals; a measure of another extract stays missing."""
    stacked = rolling.stack_year_ends(rolling.with_year_ends(quarterly))
    totals = [F.sum(f"`{m}`").alias(m) for m in measures]
    seen = F.bit_or(F.expr(f"shiftleft(1, `{rolling.QUARTER}` - 1)")).alias(SEEN)
    return stacked.groupBy(rolling.YEAR_END, *dims).agg(*totals, seen)
