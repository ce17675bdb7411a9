"""Write the tables of an extract as comma-separated text."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearwheel.sources.manifest import SharedFiles

def write_table(df: DataFrame, path: str, parts: int | None = None, mode: str = "errorifexists") -> None:
    """Comma-separated text with a header and no quoting; values are written as they are.

    Each part file carries the header. A missing value is written as ``NA``. ``parts`` limits the
    number of files of small tables; the data table keeps Spark's partitions.
    """
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NA")) for c in df.columns]
    lines = df.select(F.concat_ws(",", *cells).alias(",".join(df.columns)))
    if parts:
        lines = lines.coalesce(parts)
    # One column holds the finished line; the separator below cannot occur in it.
    lines.write.mode(mode).options(
        header=True,
        sep="\u0001",
        quote="\u0000",
        escapeQuotes=False,
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)


def write_bundle(
    tables: Mapping[str, DataFrame], folder: str, threads: int = 4, data_parts: int | None = None
) -> None:
    """Write each table to ``<folder>/<name>.csv``, all of them or none; the first one is the data table.

    Tables are written to a folder beside, which then takes its name, and a manifest of the tables is written last:
    only a folder with one counts as published. What a broken run left under the name, without
    a manifest, is moved beside and kept; a published folder is refused.

    The data table goes first and alone, with all its partitions or at most ``data_parts``. Jobs of the
    others overlap; lookups and hierarchies, which grow with their members, keep the partitions Spark gives
    them, which adaptive execution makes one for all but large ones.
    """
    data, *others = tables
    files = SharedFiles(tables[data].sparkSession, folder)
    files.refuse_published()
    beside = f"{folder}.writing-{uuid.uuid4().hex}"
    write_table(tables[data], f"{beside}/{data}.csv", parts=data_parts)
    with ThreadPoolExecutor(threads) as pool:
        list(pool.map(lambda name: write_table(_by_code(tables[name]), f"{beside}/{name}.csv"), others))
    files.publish(beside, list(tables))


def _by_code(table: DataFrame) -> DataFrame:
    key = next((c for c in ("Code", "Child") if c in table.columns), None)
    # the indexes are as long as the specification
    return table.repartitionByRange(key).sortWithinPartitions(key) if key else table.coalesce(1)
