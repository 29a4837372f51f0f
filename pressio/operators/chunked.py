"""Row lags, running totals and places whose tasks hold a part of a series.

The forms in :mod:`series` window over an entity's whole history in one task.
Here a series is cut into calendar months. What a month needs of the earlier ones is
a few numbers or rows, found on a table of one row per entity and month, so that
an entity with most of the rows is spread over its months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import as_col, quote
from ..session import ensure_checkpoint_dir


def _fresh(names: Sequence[str], *wanted: str) -> list[str]:
    """Column names like ``wanted`` that are not among ``names``."""
    used, out = {n.lower() for n in names}, []
    for w in wanted:
        while w.lower() in used:
            w += "_"
        used.add(w.lower())
        out.append(w)
    return out


def _month(date: str) -> Column:
    return F.trunc(as_col(date).cast("date"), "month")


def _unique(window, date: str, entity: str, expr: Column) -> Column:
    same = F.lag(as_col(date), 1).over(window).eqNullSafe(as_col(date)) & (F.row_number().over(window) > 1)
    return F.when(same, F.raise_error(F.lit(f"duplicate ({entity}, {date}) key"))).otherwise(expr)


def _null_safe(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def running_total_by_month(df: DataFrame, entity: str, date: str, value: str, out: str) -> DataFrame:
    """Strict running sum of ``value`` in the entity's date order (W3) as a
    prefix scan: sums per (entity, month), exclusive offsets over them, and a
    running sum within each month.

    A NULL value makes the totals from it on NULL: a month carries whether
    an earlier one holds a NULL. Integer sums equal those of
    :func:`~pressio.operators.series.running_total`; sums of doubles are
    added in another order and may differ in their last digits. A repeated
    (entity, date) fails the job; NULL entities are one series; rows without
    a date are the series' first month (two of them are a repeated key). An
    empty table gives no rows.
    """
    month, before, broken, e, m = _fresh(df.columns + [out], "month", "before", "broken", "e", "m")
    x = as_col(value)
    cut = df.withColumn(month, _month(date))
    sums = cut.groupBy(as_col(entity).alias(e), as_col(month).alias(m)).agg(
        F.sum(x).alias(before), (F.count(x) < F.count(F.lit(1))).alias(broken))
    earlier = Window.partitionBy(e).orderBy(m).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(e, m, F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before),
                          F.coalesce(F.max(broken).over(earlier), F.lit(False)).alias(broken))
    order = Window.partitionBy(as_col(entity), as_col(month)).orderBy(as_col(date))
    frame = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.when(F.count(x).over(frame) == F.count(F.lit(1)).over(frame), F.sum(x).over(frame))
    local = cut.withColumn(out, _unique(order, date, entity, own))
    on = _null_safe(as_col(entity), as_col(e)) & _null_safe(as_col(month), as_col(m))
    total = F.when(~F.col(broken), as_col(out) + F.col(before))
    return local.join(offsets, on).withColumn(out, total).drop(month, e, m, before, broken)


def lagged_increment_by_month(df: DataFrame, entity: str, date: str, value: str, n: int,
                              lag_col: str, inc_col: str) -> DataFrame:
    """Value ``n`` rows earlier in the entity's date order, and the change
    (W1, W2), with a halo: the last ``n`` rows before a month are handed to it.

    Months are numbered by the rows before them. A row is handed to those
    later months that begin less than ``n`` rows after it, so a month with
    fewer than ``n`` rows passes on what it got. At most ``n`` rows come to a
    month, at most ``n`` copies are made of a row. Results equal those of
    :func:`~pressio.operators.series.lagged_increment`, gaps in the calendar
    included. A repeated (entity, date) fails the job; NULL entities are one
    series; rows without a date are its first month.
    """
    if n < 1:
        raise ValueError("a lag of at least one row")
    month, halo, nth, e, m, start, later = _fresh(
        df.columns + [lag_col, inc_col], "month", "halo", "nth", "e", "m", "start", "later")
    cut = df.withColumn(month, _month(date))
    rows = cut.groupBy(as_col(entity).alias(e), as_col(month).alias(m)).agg(F.count(F.lit(1)).alias(nth))
    history = Window.partitionBy(e).orderBy(m)
    placed = rows.select(e, m, F.coalesce(F.sum(nth).over(
        history.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(start))
    # every month has a row: of the next n months none after these begins within n rows
    nexts = placed.select(e, m, start, F.collect_list(F.struct(F.col(m).alias("to"), F.col(start).alias("at")))
                          .over(history.rowsBetween(1, n)).alias(later))
    order = Window.partitionBy(as_col(entity), as_col(month)).orderBy(as_col(date))
    own = cut.select(as_col(entity), as_col(date), as_col(value), as_col(month),
                     F.row_number().over(order).alias(nth))
    on = _null_safe(as_col(entity), as_col(e)) & _null_safe(as_col(month), as_col(m))
    place = F.col(start) + F.col(nth)
    handed = (own.join(nexts, on)
              .select(as_col(entity), as_col(date), as_col(value), F.explode(F.filter(
                  later, lambda x: x["at"] < place + n)).alias(halo))
              .select(as_col(entity), as_col(date), as_col(value), F.col(halo)["to"].alias(month),
                      F.lit(True).alias(halo)))
    both = cut.withColumn(halo, F.lit(False)).unionByName(handed, allowMissingColumns=True)
    x = as_col(value)
    lagged = both.withColumn(lag_col, _unique(order, date, entity, F.lag(x, n).over(order)))
    return (lagged.filter(~F.col(halo)).drop(halo, month)
            .withColumn(inc_col, x - as_col(lag_col)))


def ranked(df: DataFrame, order: Sequence[Column], out: str = "rank") -> DataFrame:
    """``df`` with each row's place in an order (R4), from 1.

    The rows are sorted by range and kept so (a checkpoint); each range is
    then numbered by itself, after the rows of the ranges before it. What
    comes to the driver is one count per range, as many as there are shuffle
    partitions. Rows that are equal in the whole order are in one range, in
    any order; an empty table gives no rows.
    """
    at, = _fresh(df.columns + [out], "at")
    ensure_checkpoint_dir(df.sparkSession)
    kept = df.orderBy(*order).withColumn(at, F.monotonically_increasing_id()).checkpoint(eager=True)
    spot = F.shiftright(at, 33)
    counts = {r[0]: r[1] for r in kept.groupBy(spot).count().collect()}
    starts, total = [], 0
    for i in range(max(counts, default=0) + 1):
        starts.append(total)
        total += counts.get(i, 0)
    table = f"array({', '.join(f'{s}L' for s in starts)})"
    # the id of a row is its range's number, then its place in the range, from 0
    place = F.expr(f"element_at({table}, cast(shiftright({quote(at)}, 33) as int) + 1) "
                   f"+ ({quote(at)} & {(1 << 33) - 1}L) + 1")
    return kept.withColumn(out, place.cast("int")).drop(at)
