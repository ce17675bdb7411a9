"""Readers for fact tables, lookups, the purpose concordance and the activity classification."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearwheel.operators.clean import clean_classification
from yearwheel.operators.fill import forward_fill
from yearwheel.sources import schemas


def read_table(
    spark: SparkSession,
    path: str,
    columns: Mapping[str, str],
    fmt: str = "csv",
    number: str = "double",
) -> DataFrame:
    """Read the named columns with the named types.

    CSV cells that are blank or hold ``NA`` are missing. Columns are found by header name and the
    rest of the file is not parsed; a column that is absent or a value that does not fit its type
    is an error. ``number`` is the type of measures: ``double``, or for exact sums a decimal.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("nullValue", "NA")
    df = reader.load(path)
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    return df.select(
        *[F.col(c).cast(number if t == schemas.NUMBER else t).alias(c) for c, t in columns.items()]
    )


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Pre-built dimension lookup: Code, Description, SortOrder; any line ends, commas in quotes.

    The header must name these columns in this order.
    """
    schema = ", ".join(f"{c} {t}" for c, t in schemas.LOOKUP.items())
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_purposes(
    spark: SparkSession,
    path: str,
    purpose_at: int = 1,
    group_at: int = 7,
    line_sep: str | None = "\r\n",
) -> DataFrame:
    """Purpose concordance: POV and POV_Group, picked by position.

    The file repeats header names and has line feeds within header cells, so records are told apart
    by ``line_sep``, the CR LF pair; ``None`` reads a file with other line ends as multi-line CSV.
    """
    reader = spark.read.option("header", True)
    reader = reader.option("lineSep", line_sep) if line_sep else reader.option("multiLine", True)
    df = reader.csv(path)
    df = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return df.select(F.col(f"c{purpose_at}").alias("POV"), F.col(f"c{group_at}").alias("POV_Group"))


def read_classification(
    spark: SparkSession,
    path: str,
    position: str = "pos",
    group: str = "Activity_Group",
    activity: str = "Activity",
    fmt: str = "csv",
) -> DataFrame:
    """Activity classification: Activity_Group, filled downwards, and Activity.

    ``position`` is the column with the row number in the classification.
    """
    columns = {position: "bigint", group: "string", activity: "string"}
    df = read_table(spark, path, columns, fmt).toDF("pos", "Activity_Group", "Activity")
    filled = forward_fill(df, "Activity_Group", "pos")
    return clean_classification(filled.select("Activity_Group", "Activity"))


@dataclass(frozen=True)
class SurveyTables:
    """The inputs of the four extracts."""

    trips: DataFrame
    stays: DataFrame
    spend: DataFrame
    activities: DataFrame
    purposes: DataFrame
    classification: DataFrame
    destinations: DataFrame
    lengths_of_stay: DataFrame
    accommodation_types: DataFrame

    @classmethod
    def read(
        cls,
        spark: SparkSession,
        *,
        trips: str,
        stays: str,
        spend: str,
        activities: str,
        purposes: str,
        classification: str,
        destinations: str,
        lengths_of_stay: str,
        accommodation_types: str,
        fmt: str = "csv",
        number: str = "double",
    ) -> SurveyTables:
        """Read all inputs; ``fmt`` applies to the four fact tables."""

        def fact(path: str, columns: Mapping[str, str]) -> DataFrame:
            return read_table(spark, path, columns, fmt, number)

        return cls(
            trips=fact(trips, schemas.TRIPS),
            stays=fact(stays, schemas.STAYS),
            spend=fact(spend, schemas.SPEND),
            activities=fact(activities, schemas.ACTIVITIES),
            purposes=read_purposes(spark, purposes),
            classification=read_classification(spark, classification),
            destinations=read_lookup(spark, destinations),
            lengths_of_stay=read_lookup(spark, lengths_of_stay),
            accommodation_types=read_lookup(spark, accommodation_types),
        )
