from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """A Column from a Column or a column name (names may hold dots/spaces)."""
    if isinstance(c, Column):
        return c
    return F.col(quote(c))


def quote(name: str) -> str:
    """Back-quote a column name so dots and spaces are taken literally."""
    return "`" + name.replace("`", "``") + "`"
