"""Division with a defined result for a zero divisor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def ratio(a, b, on_zero: str = "null") -> Column:
    """``a / b`` as double.

    Under ANSI mode Spark raises on a zero divisor. ``on_zero="null"`` (the
    default) yields NULL there; ``on_zero="inf"`` yields what R yields
    (``±Inf`` for a non-zero numerator by both signs, ``NaN`` for ``0/0`` and
    ``NaN/0``).
    """
    a, b = as_col(a), as_col(b)
    q = F.try_divide(a.cast("double"), b.cast("double"))
    if on_zero == "null":
        return q
    if on_zero != "inf":
        raise ValueError(f"on_zero must be 'null' or 'inf', not {on_zero!r}")
    x, y = a.cast("double"), b.cast("double")
    # the sign of a zero divisor decides the sign of the infinity
    inf = F.when(y.cast("string") == "-0.0", F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return (F.when(x.isNull() | y.isNull(), F.lit(None).cast("double"))
            .when(y != 0, q)
            .when(F.isnan(x) | (x == 0), F.lit(float("nan")))
            .when(x > 0, inf)
            .otherwise(-inf))
