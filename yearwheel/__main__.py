"""Publish the extracts from survey files.

    spark-submit yearwheel/__main__.py --out <folder> --survey <name> --trips <path> ...
    python -m yearwheel ...
"""

from __future__ import annotations

import argparse
import json
from dataclasses import fields

from pyspark.sql import SparkSession

from yearwheel.plans import Control, extract_specs, run_all
from yearwheel.session import configured, sized_for
from yearwheel.sources import SurveyTables, column_mismatch, read_bundle


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="yearwheel", description="Publish rolling-year extracts.")
    for field in fields(SurveyTables):
        p.add_argument(f"--{field.name.replace('_', '-')}", required=True, help=f"path of the {field.name} table")
    p.add_argument("--out", required=True, help="folder that receives <run id>/Table_<id>")
    p.add_argument("--survey", required=True, help="name the table titles start with")
    p.add_argument("--run-id", help="default: the current date and time")
    p.add_argument("--extract", action="append", choices=list(extract_specs("")), help="repeatable; default: all")
    p.add_argument("--format", default="csv", choices=["csv", "parquet"], help="format of the four fact tables")
    p.add_argument("--number", default="double", help="type of measures: double or a decimal for exact sums")
    p.add_argument("--fact-bytes", type=int, help="bytes of the largest shuffle, sets the shuffle partitions; default: from the inputs' sizes")
    p.add_argument("--controls", help="JSON file: extract -> list of {measure, expected, members, how, of}")
    p.add_argument("--data-parts", type=int, help="most files of a data table, 1 for a single one; default: as Spark writes it")
    p.add_argument("--refuse-losses", action="store_true", help="stop at members without a group or code instead of reporting them")
    p.add_argument("--no-input-checks", action="store_true", help="skip the checks of the inputs")
    p.add_argument("--read-back", action="store_true", help="read each bundle back and check its columns")
    return p


def main(argv: list[str] | None = None) -> dict[str, str]:
    args = parser().parse_args(argv)
    spark = configured(SparkSession.builder.appName("yearwheel"), args.fact_bytes).getOrCreate()
    paths = {f.name: getattr(args, f.name) for f in fields(SurveyTables)}
    tables = SurveyTables.read(spark, **paths, fmt=args.format, number=args.number)
    if args.fact_bytes is None:
        sized_for(spark, [tables.trips, tables.stays, tables.spend, tables.activities])
    controls = {}
    if args.controls:
        # through Spark, so that the file may be wherever the inputs are
        text = "\n".join(r[0] for r in spark.read.text(args.controls, wholetext=True).collect())
        controls = {name: [Control(**c) for c in entries] for name, entries in json.loads(text).items()}
    folders = run_all(
        spark,
        tables,
        args.out,
        survey=args.survey,
        run_id=args.run_id,
        names=args.extract,
        strict=not args.no_input_checks,
        controls=controls,
        refuse_losses=args.refuse_losses,
        data_parts=args.data_parts,
    )
    for name, folder in folders.items():
        print(f"{name}: {folder}")
        if args.read_back and (wrong := column_mismatch(read_bundle(spark, folder))):
            raise SystemExit(f"{name}: columns differ from the indexes: {wrong}")
    return folders


if __name__ == "__main__":
    main()
