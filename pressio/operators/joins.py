"""Null-safe natural joins and the period comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_col


def natural_join(left: DataFrame, right: DataFrame, how: str = "left",
                 on: Sequence[str] | None = None, never_null: Sequence[str] = ()) -> DataFrame:
    """Join on all common column names, NULL matching NULL.

    Keys in ``never_null`` are compared with a plain ``=``, so that the join
    can reuse a partitioning by them. ``how`` is ``"left"`` or ``"right"``; the key columns come from the
    preserved side. Output order: the left side's columns, then the right
    side's non-key columns.
    A right join is planned as the mirrored left join, which lets Spark
    build the hash table on the non-preserved side.
    """
    if how not in ("left", "right", "inner"):
        raise ValueError(f"unsupported join type {how!r}")
    keys = list(on) if on is not None else [c for c in left.columns if c in set(right.columns)]
    if not keys:
        raise ValueError("no common columns to join on")
    rmap = {c: f"__r{i}" for i, c in enumerate(right.columns)}
    r = right.select(*[as_col(c).alias(rmap[c]) for c in right.columns])
    cond = None
    for k in keys:
        term = (as_col(k) == F.col(rmap[k]) if k in never_null
                else as_col(k).eqNullSafe(F.col(rmap[k])))
        cond = term if cond is None else cond & term
    if how == "right":
        joined = r.join(left, cond, "left")
    else:
        joined = left.join(r, cond, how)
    out = []
    for c in left.columns:
        if c in keys and how == "right":
            out.append(F.col(rmap[c]).alias(c))
        else:
            out.append(as_col(c))
    out += [F.col(rmap[c]).alias(c) for c in right.columns if c not in keys]
    return joined.select(*out)


def compare_periods(df: DataFrame, entity: str, date: str, value: str,
                    day_t, day_t1, out_t: str, out_t1: str) -> DataFrame:
    """Value at day ``t`` next to the value at day ``t1`` per entity.

    Keeps every entity present at ``t1`` (NULL is an entity); ``t``'s date
    and value are NULL where ``t`` lacks the entity. Columns: date, entity,
    out_t, out_t1. One scan of the two days, one aggregation by entity. An
    entity that repeats within a day fails the job.
    """
    d, v = as_col(date), as_col(value)
    at_t, at_t1 = d == F.lit(day_t), d == F.lit(day_t1)
    twice = F.raise_error(F.lit(f"duplicate ({date}, {entity}) key in the period comparison"))
    several = (F.count(F.when(at_t, 1)) > 1) | (F.count(F.when(at_t1, 1)) > 1)
    g = (df.filter(at_t | at_t1).groupBy(as_col(entity)).agg(
        F.max(F.when(at_t, d)).alias("_d"), F.max(F.when(at_t, v)).alias("_t"),
        F.max(F.when(at_t1, v)).alias("_t1"), F.count(F.when(at_t1, 1)).alias("_n"),
        several.alias("_twice")))
    return g.filter("_n > 0").select(
        F.col("_d").alias(date), as_col(entity), F.col("_t").alias(out_t),
        F.when(F.col("_twice"), twice).otherwise(F.col("_t1")).alias(out_t1))
