"""Long to wide."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_col

NULL_NAME = "NA"


def pivot_names(df: DataFrame, names_from: str, sort_names: bool = True,
                order_by: Sequence[str] | None = None) -> list[str]:
    """The distinct names that become columns, in column order.

    Sorted (binary order) when ``sort_names``; else in order of first
    appearance along ``order_by`` (the smallest ``(order_by..., name)`` per
    name). Only the distinct names reach the driver: they are its schema.
    """
    name = F.coalesce(as_col(names_from).cast("string"), F.lit(NULL_NAME))
    if sort_names or not order_by:
        return sorted(r["n"] for r in df.select(name.alias("n")).distinct().collect())
    first = F.min(F.struct(*[as_col(c) for c in order_by], name.alias("n")))
    rows = df.groupBy(name.alias("n")).agg(first.alias("f")).collect()
    return [r["n"] for r in sorted(rows, key=lambda r: tuple(r["f"]))]


def pivot_wide(df: DataFrame, ids: Sequence[str], names_from: str, values_from: str,
               names: Sequence[str] | None = None, sort_names: bool = True,
               order_by: Sequence[str] | None = None) -> DataFrame:
    """One column per name, one row per id combination.

    Missing cells are NULL. Two rows for the same (ids, name) fail the job
    (a wide cell holds one value). NULL names form the column ``NA``. With
    ``names`` given no job runs to find them, and a row of another name
    fails the job. Plan: one aggregation keyed by (ids, name), then a
    pivot-first aggregation keyed by ids.
    """
    name = F.coalesce(as_col(names_from).cast("string"), F.lit(NULL_NAME))
    if names is None:
        names = pivot_names(df, names_from, sort_names, order_by)
    elif names:
        known = F.array(*[F.lit(n) for n in names])
        name = F.when(F.array_contains(known, name), name).otherwise(F.raise_error(
            F.concat(F.lit("pivot name not in the given list: "), name)))
    if not names:  # no rows: the ids alone, one row per id combination
        return df.select(*[as_col(i) for i in ids]).distinct()
    base = df.select(*[as_col(i) for i in ids], name.alias("_name"),
                     as_col(values_from).alias("_v"))
    wide = (base.groupBy(*[as_col(i) for i in ids]).pivot("_name", list(names))
            .agg(F.first("_v").alias("v"), F.count(F.lit(1)).alias("n")))
    cells = []
    for nm in names:
        v = F.col(_q(f"{nm}_v"))
        n = F.col(_q(f"{nm}_n"))
        cells.append(F.when(n > 1, F.raise_error(F.lit(
            f"duplicate key in pivot for name {nm!r}"))).otherwise(v).alias(nm))
    return wide.select(*[as_col(i) for i in ids], *cells)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
