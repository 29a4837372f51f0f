"""Grouped sums and means, row lags and running totals."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import as_col, strict_mean, strict_running_sum, strict_sum
from .conform import numeric_columns


def sum_by(df: DataFrame, keys: Sequence[str],
           measures: Sequence[str] | None = None) -> DataFrame:
    """Strict sum of every measure per key.

    ``measures`` defaults to every numeric column not in ``keys``; other
    columns are dropped (they collapse, like an age band). Partial
    aggregation runs before the shuffle, so a hot key costs one row per map
    task in the exchange.
    """
    ms = list(measures) if measures is not None else numeric_columns(df, keys)
    return df.groupBy(*[as_col(k) for k in keys]).agg(
        *[strict_sum(m).alias(m) for m in ms])


# Doubles below this are split exactly into an integer and two 40-bit parts.
_SPLIT_LIMIT = float(2 ** 62)
_PART = float(2 ** 40)


def _exact_decimal(q):
    """An integral double below 2**102 as a decimal. (Spark's cast takes the
    shortest digits that print the double, which need not be its value.)"""
    step = float(2 ** 51)
    high = F.floor(q / F.lit(step))
    low = (q - high * F.lit(step)).cast("long")
    return (high.cast("decimal(17,0)") * F.lit(Decimal(2 ** 51)).cast("decimal(16,0)")
            + low.cast("decimal(20,0)")).cast("decimal(38,0)")


def mean_by(df: DataFrame, keys: Sequence[str], value: str, out: str,
            method: str = "avg", scale: int = 2) -> DataFrame:
    """Strict mean of ``value`` per key.

    ``method``:

    * ``"avg"`` - Spark's ``avg`` (sum / count).
    * ``"exact"`` - the mean of the binary doubles, rounded once: each value
      is split into its integer part and two 40-bit parts of its fraction,
      the three are summed as decimals without error, and one division
      follows. Independent of row order and partitioning; R's two-pass mean
      gives the same. Where a group holds NaN, an infinity or a value of
      2**62 or more, its mean is that of plain doubles (R: Inf stays Inf).

    * ``"decimal"`` - the mean of values that carry at most ``scale``
      decimals: the integer sum of ``x * 10^scale`` and the count, divided
      once; values too large for that as under ``"exact"``.

    All aggregate partially before the shuffle; a group may be of any size.
    """
    x = as_col(value).cast("double")
    keycols = [as_col(k) for k in keys]
    if method == "avg":
        return df.groupBy(*keycols).agg(strict_mean(x).alias(out))
    if method == "decimal":
        p = 10 ** scale
        units = x * F.lit(float(p))
        fits = F.abs(units) < F.lit(_SPLIT_LIMIT)
        total = F.sum(F.rint(F.when(fits, units)).cast("long").cast("decimal(20,0)"))
        n = F.count(F.lit(1)).cast("double")
        mean = F.when(F.count(F.when(~fits, 1)) > 0, F.sum(x) / n).otherwise(
            total.cast("double") / (n * F.lit(float(p))))
        return df.groupBy(*keycols).agg(
            F.when(F.count(x) == F.count(F.lit(1)), mean).alias(out))
    if method != "exact":
        raise ValueError(f"unknown mean method {method!r}")
    splits = F.abs(x) < F.lit(_SPLIT_LIMIT)
    v = F.when(splits, x).otherwise(F.lit(0.0))
    whole = F.floor(v)
    first = (v - whole) * F.lit(_PART)
    second = (first - F.floor(first)) * F.lit(_PART)
    parts = [F.sum(p.cast("decimal(20,0)")) for p in (whole, F.floor(first), F.floor(second))]
    g = df.groupBy(*keycols).agg(
        *[p.alias(f"_p{i}") for i, p in enumerate(parts)],
        F.sum(x).alias("_s"), F.count(F.lit(1)).alias("_n"),
        (F.count(x) == F.count(F.lit(1))).alias("_ok"),
        F.count(F.when(~splits, 1)).alias("_odd"))
    n = F.col("_n").cast("double")
    # total in units of 2**-40 is q * n + r whatever integer q is taken; both exact
    total = (F.col("_p0") * F.lit(Decimal(2 ** 40)).cast("decimal(13,0)") + F.col("_p1")).cast("decimal(38,0)")
    q = F.rint(total.cast("double") / n)
    r = (total - (_exact_decimal(q) * F.col("_n").cast("decimal(20,0)"))).cast("double")
    exact = (q + (r + F.col("_p2").cast("double") / F.lit(_PART)) / n) / F.lit(_PART)
    mean = F.when(F.col("_odd") > 0, F.col("_s") / n).otherwise(exact)
    return g.select(*keycols, F.when(F.col("_ok"), mean).alias(out))


def _series_window(entity: str, date: str):
    return Window.partitionBy(as_col(entity)).orderBy(as_col(date))


def _unique_guard(entity: str, date: str, expr):
    """``expr``, failing the job when (entity, date) repeats."""
    w = _series_window(entity, date)
    dup = F.lag(as_col(date), 1).over(w) == as_col(date)
    return F.when(dup, F.raise_error(F.lit(
        f"duplicate ({entity}, {date}) key"))).otherwise(expr)


def lagged_increment(df: DataFrame, entity: str, date: str, value: str, n: int,
                     lag_col: str, inc_col: str) -> DataFrame:
    """Value ``n`` rows earlier in the entity's date order, and the change.

    ``n`` counts rows, not days: a calendar gap makes the lag reach further
    back. The first ``n`` rows per entity get NULL. The change may be
    negative (corrections are not clamped). A repeated (entity, date) fails
    the job. One exchange on the entity; the rows of one entity are at most
    one per date, so no group grows with the data volume.
    """
    w = _series_window(entity, date)
    x = as_col(value)
    lagged = _unique_guard(entity, date, F.lag(x, n).over(w))
    return (df.withColumn(lag_col, lagged)
            .withColumn(inc_col, x - F.col(lag_col)))


def running_total(df: DataFrame, entity: str, date: str, value: str,
                  out: str) -> DataFrame:
    """Strict running sum of ``value`` in the entity's date order."""
    w = _series_window(entity, date).rowsBetween(Window.unboundedPreceding,
                                                 Window.currentRow)
    total = _unique_guard(entity, date, strict_running_sum(value, w))
    return df.withColumn(out, total)


def weighted_count(df: DataFrame, keys: Sequence[str], weight: str,
                   out: str) -> DataFrame:
    """Sum of ``weight`` per key, missing weights ignored, 0 for none.

    The published order (R4) is that of ``plans.products.population_order``.
    """
    return df.groupBy(*[as_col(k) for k in keys]).agg(
        F.coalesce(F.sum(as_col(weight)), F.lit(0)).alias(out))
