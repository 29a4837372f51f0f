"""Aggregates with R's NA semantics: one missing value makes the result missing.

Spark's ``sum``/``avg`` skip NULLs. The guard ``count(x) == count(*)`` over
the same group or frame restores "any NULL -> NULL" without a UDF, so the
partial/final aggregation split and codegen are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from ._util import as_col


def _complete(x: Column) -> Column:
    return F.count(x) == F.count(F.lit(1))


def strict_sum(c) -> Column:
    """``sum`` that is NULL when any input is NULL."""
    x = as_col(c)
    return F.when(_complete(x), F.sum(x))


def strict_mean(c) -> Column:
    """``avg`` that is NULL when any input is NULL."""
    x = as_col(c)
    return F.when(_complete(x), F.avg(x))


def strict_running_sum(c, window: WindowSpec) -> Column:
    """Running ``sum`` over ``window`` (a rows frame) that stays NULL from the
    first NULL on: 1, NULL, 4 -> 1, NULL, NULL."""
    x = as_col(c)
    return F.when(F.count(x).over(window) == F.count(F.lit(1)).over(window),
                  F.sum(x).over(window))
