from blotter.functions.months import (
    month_filter,
    month_of,
    month_spine,
    month_start,
    month_start_fmt,
    months_to_outcome,
)
from blotter.functions.values import exact_mean, exact_sum, label_null, share, try_double

__all__ = [
    "exact_mean",
    "exact_sum",
    "label_null",
    "month_filter",
    "month_of",
    "month_spine",
    "month_start",
    "month_start_fmt",
    "months_to_outcome",
    "share",
    "try_double",
]
