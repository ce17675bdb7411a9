from yearwheel.plans.extracts import (
    Control,
    Extract,
    build_extract,
    extract_specs,
    input_checks,
    purposes_unused,
    survey_extract,
)
from yearwheel.plans.facts import Facts, fact_pass
from yearwheel.plans.run import new_run_id, publish, run_all
from yearwheel.plans.spec import Dimension, ExtractSpec, Measure
from yearwheel.plans.store import TotalsStore

__all__ = [
    "Control",
    "Dimension",
    "Extract",
    "ExtractSpec",
    "Facts",
    "Measure",
    "TotalsStore",
    "build_extract",
    "extract_specs",
    "fact_pass",
    "input_checks",
    "new_run_id",
    "publish",
    "purposes_unused",
    "run_all",
    "survey_extract",
]
