"""The given tables seen as survey tables.

orders with customer and nation are the trips, lineitem plays stays, spend and activities. The
definitions mirror the common table expressions of ``parity.oracle``.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# One row per purpose known to the concordance; the last one has no trips.
PURPOSES = [
    ("1-URGENT", "Business"),
    ("2-HIGH", "Business"),
    ("3-MEDIUM", "Holiday"),
    ("5-LOW", "Holiday"),
    ("None", "Other"),
    ("Sightseeing", "Holiday"),
]
# Leaves out a purpose that has trips.
PARTIAL_PURPOSES = [row for row in PURPOSES if row[0] != "5-LOW"]
# Accommodation types are the part types.
ACCOMMODATION_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "All"]
# Bands with a code; the two longest have none.
BANDS = [f"{n} nights" for n in range(15)] + [
    "15 nights to less than one month",
    "One month to less than two months",
    "Two months to less than three months",
    "Three months to less than six months",
    "All",
]

MONEY = "decimal(18,2)"
WHOLE = "decimal(9,0)"


# Columns in use; a stated schema saves the job that would infer it.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double, "
    "l_returnflag string, l_linestatus string",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
}


# Eleven dimensions of the orders, text and others; the SQL of each holds in Spark and in DuckDB.
WIDE_SQL = {
    "d1": "o_orderstatus",
    "d2": "o_orderpriority",
    "d3": "CAST(year(o_orderdate) % 2 AS INT)",
    "d4": "make_date(CAST(2000 + year(o_orderdate) % 2 AS INT), 1, 1)",
    "d5": "o_orderstatus = 'F'",
    "d6": "CAST(substr(o_orderpriority, 1, 1) AS INT)",
    "d7": "lower(o_orderstatus)",
    "d8": "year(o_orderdate) % 2 = 1",
    "d9": "'one'",
    "d10": "substr(o_orderpriority, 3)",
    "d11": "CAST(length(o_orderpriority) AS BIGINT)",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def inline(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(pa.table(dict(zip(columns, zip(*rows, strict=True), strict=True))))


def lookup(spark: SparkSession, members: list[str]) -> DataFrame:
    rows = [(i, m, i) for i, m in enumerate(members, 1)]
    return inline(spark, ["Code", "Description", "SortOrder"], rows).selectExpr(
        "cast(Code as int) Code", "Description", "cast(SortOrder as int) SortOrder"
    )


def purposes(spark: SparkSession, rows: list[tuple[str, str]] = PURPOSES) -> DataFrame:
    return inline(spark, ["POV", "POV_Group"], rows)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation = (load(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    day = F.col("o_orderstatus") == "F"
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("TripIDNumber"),
            F.year("o_orderdate").alias("TripYear"),
            F.quarter("o_orderdate").alias("TripQtr"),
            F.when(day, "Day Trip").otherwise("Overnight Trip").alias("TripType"),
            F.col("n_name").alias("DestinationRTO"),
            F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("POV"),
            F.col("c_acctbal").cast(MONEY).alias("RespondentWeight"),
            F.col("o_totalprice").cast(MONEY).alias("SmoothedTripWeight"),
            F.dayofmonth("o_orderdate").cast(WHOLE).alias("ExpenditureWeight"),
            F.when(~day, F.col("o_totalprice").cast(MONEY)).alias("ImputedSpendAccom"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast(MONEY)).alias("ImputedSpendTrnsport"),
        )
    )


def _lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    lines, part = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "part")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(*columns)


def stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, "l_orderkey", "p_type", "l_quantity").select(
        F.col("l_orderkey").alias("TripID"),
        F.col("p_type").alias("AccommodationType"),
        (8 * (F.col("l_quantity") - 1)).cast(WHOLE).alias("NoNights"),
    )


def spend_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend, several rows per trip and type."""
    kind = (
        F.when(F.col("l_returnflag") == "N", "Gifts")
        .when(F.col("l_linestatus") == "F", "Alcohol")
        .otherwise("Food And Alcohol")
    )
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("TripID"),
        kind.alias("SpendType"),
        F.col("l_extendedprice").cast(MONEY).alias("ImputedSpendAmt"),
    )


def spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend, one row per trip and type."""
    return (
        spend_lines(spark, sf_dir)
        .groupBy("TripID", "SpendType")
        .agg(F.sum("ImputedSpendAmt").alias("ImputedSpendAmt"))
    )


def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, "l_orderkey", "p_name").select(
        F.col("l_orderkey").alias("TripID"), F.col("p_name").alias("Activities")
    )


def classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity and its group, one row per activity."""
    part = load(spark, sf_dir, "part")
    return part.groupBy(F.col("p_name").alias("Activity")).agg(F.min("p_type").alias("Activity_Group"))


def sparse_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification in file order with the group stated on some rows only."""
    stated = F.when(F.col("p_size") <= 7, F.col("p_brand"))
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("pos"), stated.alias("Activity_Group"), F.col("p_name").alias("Activity")
    )


def destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplied destination lookup: nations in key order, then the total."""
    nation = load(spark, sf_dir, "nation")
    coded = nation.select((F.col("n_nationkey") + 1).alias("Code"), F.col("n_name").alias("Description"))
    total = nation.agg((F.max("n_nationkey") + 2).alias("Code")).withColumn("Description", F.lit("All"))
    return coded.unionByName(total).withColumn("SortOrder", F.col("Code"))
