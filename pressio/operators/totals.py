"""Total entity per date and grand-total rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_col, strict_sum
from .conform import require_not_label


def _detail_or_null(col_name: str, grouped) -> "F.Column":
    return F.when(grouped == 0, F.first(as_col(col_name)))


def _checked_sums(measures: Sequence[str], bad, error) -> list:
    """Strict sums of the measures; the first one fails the job when ``bad``
    (carried by a kept column, so pruning cannot drop the check)."""
    sums = [strict_sum(m).alias(m) for m in measures]
    if measures:
        m0 = measures[0]
        sums[0] = F.when(bad, error).otherwise(strict_sum(m0)).alias(m0)
    return sums


def with_total(df: DataFrame, date: str, entity: str, measures: Sequence[str],
               label: str) -> DataFrame:
    """Append, per date, one row for the total entity ``label`` (A1).

    Detail rows keep their values; the total row holds the strict sum of
    each measure over all entities of that date; other columns are NULL
    there. Rows with a NULL date belong to no date and are dropped (F12).
    Fails the job if an entity is already named ``label`` or if a
    (date, entity) pair repeats. That holds for a NULL entity too: two
    unnamed rows of one date could not be told apart by the lag that follows,
    so they are refused rather than summed.

    One pass over the input: ``GROUPING SETS ((date, entity), (date))``.
    A detail group holds exactly one row (checked), so its strict sums are
    the row's values; the date set is partially aggregated before the
    shuffle. A union of the rows with a separate aggregate would evaluate
    the input twice (its two branches prune different columns, so Spark
    cannot reuse one for the other).
    """
    base = df.filter(as_col(date).isNotNull()).withColumn(
        entity, require_not_label(entity, label))
    others = [c for c in df.columns if c not in (date, entity, *measures)]
    e = as_col(entity)
    g = F.grouping(e)
    dup = F.raise_error(F.lit(f"duplicate ({date}, {entity}) key before the total"))
    aggs = _checked_sums(measures, (g == 0) & (F.count(F.lit(1)) > 1), dup)
    aggs += [_detail_or_null(c, g).alias(c) for c in others]
    aggs += [g.alias("_g")]
    grouped = base.groupingSets([[date, entity], [date]], date, entity).agg(*aggs)
    out = grouped.withColumn(entity, F.when(F.col("_g") == 1, F.lit(label)).otherwise(e))
    return out.select(*[as_col(c) for c in df.columns])


def with_grand_total(df: DataFrame, entity: str, measures: Sequence[str],
                     label: str) -> DataFrame:
    """Append one row ``label`` with the strict sum of each measure.

    One pass: ``GROUPING SETS ((entity), ())``; each entity holds one row
    (checked), so its detail group reproduces it.
    """
    base = df.withColumn(entity, require_not_label(entity, label))
    others = [c for c in df.columns if c not in (entity, *measures)]
    e = as_col(entity)
    g = F.grouping(e)
    dup = F.raise_error(F.lit(f"duplicate {entity} key before the grand total"))
    aggs = _checked_sums(measures, (g == 0) & (F.count(F.lit(1)) > 1), dup)
    aggs += [_detail_or_null(c, g).alias(c) for c in others]
    aggs += [g.alias("_g")]
    grouped = base.groupingSets([[entity], []], entity).agg(*aggs)
    out = grouped.withColumn(entity, F.when(F.col("_g") == 1, F.lit(label)).otherwise(e))
    return out.select(*[as_col(c) for c in df.columns])


def sum_with_total(df: DataFrame, date: str, entity: str, value: str, out: str,
                   label: str) -> DataFrame:
    """Strict sum of ``value`` per (date, entity) plus a total per date (A2+A5).

    One pass: ``GROUPING SETS ((date, entity), (date))`` - Expand, partial
    aggregate, one exchange, final aggregate. The total set is labelled from
    ``grouping(entity)``. An entity already named ``label`` fails the job.
    """
    base = (df.filter(as_col(date).isNotNull())
            .select(as_col(date).alias(date),
                    require_not_label(entity, label).alias(entity),
                    as_col(value).alias(value)))
    e = as_col(entity)
    grouped = base.groupingSets([[date, entity], [date]], date, entity)
    return (grouped.agg(F.grouping(e).alias("_g"), strict_sum(value).alias(out))
            .select(as_col(date),
                    F.when(F.col("_g") == 1, F.lit(label)).otherwise(e).alias(entity),
                    as_col(out)))
