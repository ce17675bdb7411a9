"""Read a published bundle back."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from yearwheel.sources.manifest import SharedFiles

@dataclass(frozen=True)
class Bundle:
    """A published extract. The raw tables keep the quotes that the parsed ones have taken off."""

    table_id: str
    data: DataFrame
    dimension_index: DataFrame
    measure_index: DataFrame
    file_index: DataFrame
    lookups: dict[str, DataFrame]
    raw_lookups: dict[str, DataFrame]
    raw_indexes: dict[str, DataFrame]
    hierarchies: dict[str, DataFrame]


def read_bundle(spark: SparkSession, path: str) -> Bundle:
    """Read the tables named by the bundle's own indexes, below ``path``; only of a bundle that is published."""
    SharedFiles(spark, path).tables()

    def table(name: str, quote: str = '"') -> DataFrame:
        return spark.read.option("header", True).option("quote", quote).csv(f"{path}/{name}.csv")

    file_index = table("FileIndex")
    dimension_index = table("DimensionIndex")
    table_id = file_index.select("TableID").first()[0]
    dims = [row[0] for row in dimension_index.select("DimensionCode").collect()]
    files = {dim: re.sub('["_]', "", dim) + table_id for dim in dims}
    return Bundle(
        table_id=table_id,
        data=table(f"Data{table_id}"),
        dimension_index=dimension_index,
        measure_index=table("MeasureIndex"),
        file_index=file_index,
        lookups={dim: table(f"DimenLookup{f}") for dim, f in files.items()},
        raw_lookups={dim: table(f"DimenLookup{f}", quote="") for dim, f in files.items()},
        raw_indexes={name: table(name, quote="") for name in ("DimensionIndex", "MeasureIndex")},
        hierarchies={dim: table(f"DimenHierarchy{f}") for dim, f in files.items()},
    )


def column_mismatch(bundle: Bundle) -> list[tuple[str | None, str | None]]:
    """Columns of the data table against the two indexes, in order; empty when they conform."""
    dims = [row[0] for row in bundle.dimension_index.select("DimensionCode").collect()]
    measures = [row[0] for row in bundle.measure_index.select("MeasureCode").collect()]
    found, stated = bundle.data.columns, dims + measures
    length = max(len(found), len(stated))
    pad = lambda names: names + [None] * (length - len(names))
    return [pair for pair in zip(pad(found), pad(stated), strict=True) if pair[0] != pair[1]]
