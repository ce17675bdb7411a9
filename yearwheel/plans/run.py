"""Publish extracts under a run id."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from yearwheel.operators import checks
from yearwheel.operators.staging import Staging
from yearwheel.plans.extracts import Control, Extract, extract_specs, purposes_unused, survey_extract
from yearwheel.plans.facts import fact_pass
from yearwheel.sinks.bundle import write_bundle, write_table
from yearwheel.sources.manifest import SharedFiles
from yearwheel.sources.tables import SurveyTables


def new_run_id() -> str:
    """``YYYYMMDD-HHMM``."""
    return datetime.now().strftime("%Y%m%d-%H%M")


def publish(extract: Extract, out: str, run_id: str, data_parts: int | None = None) -> str:
    """Write one extract to ``<out>/<run_id>/Table_<id>``; an existing table is not overwritten.

    The totals that found no group or no code go to ``<out>/<run_id>/Losses_<id>.csv`` beside it.
    ``data_parts`` limits the number of files of the data table; 1 gives a single file.
    """
    folder = f"{out}/{run_id}/Table_{extract.spec.table_id}"
    SharedFiles(extract.base.sparkSession, folder).refuse_published()
    # what a broken run left of the losses goes; they are final once the bundle is published
    write_table(extract.losses, f"{out}/{run_id}/Losses_{extract.spec.table_id}.csv", parts=1, mode="overwrite")
    write_bundle(extract.tables(), folder, data_parts=data_parts)
    return folder


def run_all(
    spark: SparkSession,
    tables: SurveyTables,
    out: str,
    *,
    survey: str,
    run_id: str | None = None,
    names: Iterable[str] | None = None,
    controls: Mapping[str, Iterable[Control]] | None = None,
    strict: bool = True,
    refuse_losses: bool = False,
    data_parts: int | None = None,
) -> dict[str, str]:
    """Build, check and publish the extracts one after the other; returns their folders by name.

    ``controls`` are control figures per extract. The fact tables are scanned once for all extracts. ``strict`` checks
    the inputs in the same scan, and that all purposes occur and breakdowns agree, from the staged totals.
    ``refuse_losses`` also refuses purposes and activities without a group and members without a code, which
    are otherwise reported. A failed check stops the run before the extract is written.
    """
    run_id = run_id or new_run_id()
    specs = extract_specs(survey)
    folders = {}
    names = list(names or specs)
    with Staging(spark) as shared:
        facts = fact_pass(tables, names, shared, strict=strict)
        if facts.spend_rules is not None:
            checks.require(facts.spend_rules)
        for name in names:
            with Staging(spark) as stage:
                extract = survey_extract(name, specs[name], tables, stage, facts)
                found = [extract.reconcile(controls[name])] if controls and controls.get(name) else []
                if strict and name in ("trips", "spend"):
                    found.append(purposes_unused(tables, extract))
                if strict and (agreed := extract.breakdown_checks()) is not None:
                    found.append(agreed)
                if refuse_losses:
                    found.append(checks.no_rows(extract.losses, f"members of {name} without a group or code"))
                if found:
                    checks.require(reduce(DataFrame.unionByName, found))
                folders[name] = publish(extract, out, run_id, data_parts)
    return folders
