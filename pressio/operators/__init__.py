"""DataFrame -> DataFrame operators, parameterised by column names."""

from .chunked import lagged_increment_by_month, ranked, running_total_by_month
from .conform import (as_of, date_range, derive, drop_incomplete, drop_last_key,
                      map_numeric, numeric_columns, project, recode, relabel)
from .joins import compare_periods, natural_join
from .kpi import kpi_steps, stress_kpis
from .reshape import pivot_names, pivot_wide
from .series import (lagged_increment, mean_by, running_total, sum_by,
                     weighted_count)
from .totals import sum_with_total, with_grand_total, with_total

__all__ = [
    "as_of", "date_range", "derive", "drop_incomplete", "drop_last_key",
    "map_numeric", "numeric_columns", "project", "recode", "relabel",
    "compare_periods", "natural_join", "kpi_steps",
    "stress_kpis", "pivot_names", "pivot_wide", "lagged_increment", "mean_by",
    "running_total", "sum_by", "weighted_count", "sum_with_total",
    "with_grand_total", "with_total", "lagged_increment_by_month", "ranked",
    "running_total_by_month",
]
