"""Text forms used in published tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def measure_text(value: Column, decimals: int = 0) -> Column:
    """Number as plain text with a fixed number of decimals, ties to even, never an exponent."""
    return F.bround(value, decimals).cast(f"decimal(38,{decimals})").cast("string")


def quoted(value: Column) -> Column:
    """Value wrapped in double quotes."""
    return F.concat(F.lit('"'), value, F.lit('"'))
