"""Calendar helpers: date parsing, week number and week label."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# A year-month-day text: four digits, month, day; either eight digits in a row
# or any separators that are not digits; what follows the day is ignored. The
# last alternative takes every other text, of which no part is left.
_DAY = r"(?s)^(?:\s*(\d{4})(?:(\d{2})(\d{2})|[^0-9]+(\d{1,2})[^0-9]+(\d{1,2}))(?!\d).*|.*)"
_PARTS = "$1-$2$4-$3$5"


def date_token(c) -> Column:
    """Text up to the first ``T`` or whitespace (D2): the date part of an ISO
    date-time written either way (``2020-02-24T18:00:00``,
    ``2020-02-24 18:00:00``)."""
    return F.regexp_extract(as_col(c).cast("string"), r"^([^T\s]+)", 1)


def parse_day(c) -> Column:
    """Year-month-day text (or a date-time) to DATE (D1): ``2009-01-04``,
    ``2009-1-4``, ``2009.01.04``, ``2009/01/04``, ``2009 01 03``,
    ``20090104``. Unreadable or impossible dates (``2021-02-30``) become NULL
    instead of failing; :func:`rejected_day` tells them from missing ones."""
    return F.regexp_replace(as_col(c).cast("string"), _DAY, _PARTS).try_cast("date")


def rejected_day(c) -> Column:
    """Whether a text is given but no day can be read from it."""
    text = as_col(c).cast("string")
    return text.isNotNull() & (F.trim(text) != "") & parse_day(c).isNull()


def week_number(c) -> Column:
    """Week of the year counted from 1 January in blocks of 7 days, 1..53 (D3).

    Not the ISO week: week 1 always starts on 1 January.
    """
    d = as_col(c)
    return (F.floor((F.dayofyear(d) - 1) / 7) + 1).cast("int")


def week_label(year, week) -> Column:
    """Monday of Sunday-first week ``week`` of ``year``.

    Week 1 begins on the year's first Sunday; the label is the day after it
    plus ``week - 1`` weeks. A display key: it need not bracket the days of
    a :func:`week_number` week.
    """
    y, w = as_col(year), as_col(week)
    jan1 = F.make_date(y, F.lit(1), F.lit(1))
    first_sunday = F.date_add(jan1, ((F.lit(8) - F.dayofweek(jan1)) % 7).cast("int"))
    return F.date_add(first_sunday, ((w - 1) * 7 + 1).cast("int"))


def days_before(as_of: dt.date, k: int) -> Column:
    """``as_of - k`` days as a DATE literal (D5); folded at plan time so a
    filter on it reaches the scan."""
    return F.lit(as_of - dt.timedelta(days=k))
