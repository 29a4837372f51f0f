"""Column-level functions (all built-in Spark expressions, no UDFs)."""

from ._util import as_col, quote
from .arithmetic import ratio
from .dates import (date_token, days_before, parse_day, rejected_day,
                    week_label, week_number)
from .nulls import strict_mean, strict_running_sum, strict_sum
from .rounding import number_text, round_r

__all__ = [
    "as_col", "quote", "ratio", "date_token", "days_before", "parse_day",
    "rejected_day",
    "week_label", "week_number", "strict_mean", "strict_running_sum",
    "strict_sum", "number_text", "round_r",
]
