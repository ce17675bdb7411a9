from yearwheel.sources.bundle import Bundle, column_mismatch, read_bundle
from yearwheel.sources.tables import (
    SurveyTables,
    read_classification,
    read_lookup,
    read_purposes,
    read_table,
)

__all__ = [
    "Bundle",
    "SurveyTables",
    "column_mismatch",
    "read_bundle",
    "read_classification",
    "read_lookup",
    "read_purposes",
    "read_table",
]
