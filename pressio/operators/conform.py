"""Projection, renaming, derivation, recoding and row filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions import as_col, days_before


def project(df: DataFrame, mapping) -> DataFrame:
    """Select and rename in one step (F1, F2).

    ``mapping`` is a sequence of names, or of ``(new, old_or_Column)`` pairs,
    or a dict ``{new: old_or_Column}`` (insertion order kept).
    """
    items = mapping.items() if isinstance(mapping, Mapping) else mapping
    cols = []
    for item in items:
        if isinstance(item, str):
            cols.append(as_col(item))
        else:
            new, src = item
            cols.append(as_col(src).alias(new))
    return df.select(*cols)


def relabel(df: DataFrame, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """Rename columns to display labels.

    ``pairs`` holds ``(label, column)``; columns not named keep their name.
    A column labelled more than once takes its last label (F3a).
    """
    last: dict[str, str] = {}
    for label, column in pairs:
        last[column] = label
    return df.select(*[as_col(c).alias(last.get(c, c)) for c in df.columns])


def derive(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Add or replace columns in order; each step sees the ones before.

    Catalyst collapses the chain into one projection.
    """
    for name, expr in steps:
        df = df.withColumn(name, expr)
    return df


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in skip]


def map_numeric(df: DataFrame, fn: Callable[[str], Column],
                exclude: Iterable[str] = (), only_fractional: bool = False) -> DataFrame:
    """Apply ``fn`` (given the column name) to every numeric column,
    ``exclude`` left out (F5).

    With ``only_fractional`` integral columns are passed through (rounding an
    integer is the identity, and keeping the integer type keeps sums exact).
    """
    skip = set(exclude)
    out = []
    for f in df.schema.fields:
        numeric = isinstance(f.dataType, NumericType) and f.name not in skip
        if numeric and only_fractional and f.dataType.typeName() in (
                "byte", "short", "integer", "long"):
            numeric = False
        out.append(fn(f.name).alias(f.name) if numeric else as_col(f.name))
    return df.select(*out)


def recode(df: DataFrame, column: str, mapping) -> DataFrame:
    """Replace values by a mapping, others unchanged, NULL stays NULL.

    A key that repeats takes its first value, as in a chain of conditions.
    The mapping is a driver-side literal, one map lookup however long, so no
    join and no shuffle are needed.
    """
    first: dict = {}
    for old, new in (mapping.items() if isinstance(mapping, Mapping) else mapping):
        first.setdefault(old, new)
    if not first:
        return df
    c = as_col(column)
    lookup = F.create_map(*[F.lit(v) for kv in first.items() for v in kv])
    known = F.map_contains_key(lookup, c)
    return df.withColumn(column, F.when(known, F.try_element_at(lookup, c)).otherwise(c))


def as_of(df: DataFrame, date_col: str, day: dt.date, k: int = 0) -> DataFrame:
    """Rows of the day ``day - k`` (F6); the literal reaches the scan."""
    return df.filter(as_col(date_col) == days_before(day, k))


def date_range(df: DataFrame, date_col: str, lo: dt.date, hi: dt.date) -> DataFrame:
    """Rows with ``lo <= date <= hi``."""
    return df.filter(as_col(date_col).between(F.lit(lo), F.lit(hi)))


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL (or NaN) in any column of ``subset`` (F8)."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def drop_last_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop the rows holding the greatest key in ``keys`` order.

    The greatest key is a one-row aggregate used as a scalar subquery, so no
    global window (single partition) is needed.
    """
    key = F.struct(*[as_col(k) for k in keys])
    top = df.select(F.max(key).alias("k")).scalar()
    return df.filter(key < top)


def require_not_label(c, label: str, what: str = "entity") -> Column:
    """``c`` unchanged, failing the job if a value equals the total label."""
    col = as_col(c)
    return F.when(col == F.lit(label), F.raise_error(F.lit(
        f"{what} value equals the total label {label!r}"))).otherwise(col)

