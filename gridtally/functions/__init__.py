"""Column expressions: null rules, numbers, text and time."""

from gridtally.functions.numbers import (
    deadband,
    gigawatt_hours,
    weighted_mean,
    weighted_ratio,
)
from gridtally.functions.nulls import (
    UNKNOWN,
    lenient_sum,
    named_or_unknown,
    strict_avg,
    strict_sum,
    zero_if_null,
)
from gridtally.functions.text import (
    after_last,
    before_first,
    drop_suffix,
    file_extension,
    file_prefix,
    first_number,
)
from gridtally.functions.times import (
    add_hours,
    days_in_year,
    hour_of_year,
    hour_start,
    hours_in_year,
    year_start,
)

__all__ = [
    "UNKNOWN",
    "add_hours",
    "after_last",
    "before_first",
    "days_in_year",
    "deadband",
    "drop_suffix",
    "file_extension",
    "file_prefix",
    "first_number",
    "gigawatt_hours",
    "hour_of_year",
    "hour_start",
    "hours_in_year",
    "lenient_sum",
    "named_or_unknown",
    "strict_avg",
    "strict_sum",
    "weighted_mean",
    "weighted_ratio",
    "year_start",
    "zero_if_null",
]
