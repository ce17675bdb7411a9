from yearwheel.functions.banding import length_of_stay_band
from yearwheel.functions.periods import (
    YEAR_END_LABELS,
    lagged_month_end,
    quarter_end_date,
    year_end_description,
    year_end_label,
    year_end_quarter,
    year_end_year,
)
from yearwheel.functions.recode import recode
from yearwheel.functions.text import measure_text, quoted

__all__ = [
    "YEAR_END_LABELS",
    "lagged_month_end",
    "length_of_stay_band",
    "measure_text",
    "quarter_end_date",
    "quoted",
    "recode",
    "year_end_description",
    "year_end_label",
    "year_end_quarter",
    "year_end_year",
]
