"""Rounding and number text as plain column expressions (stay in codegen)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col, quote

# Beyond 2**52 every double is integral at any precision we round to.
_EXACT_LIMIT = float(2 ** 52)


def round_r(c, digits: int = 0) -> Column:
    """Round to ``digits`` decimals the way R >= 4 does (M2).

    Of the two ``digits``-decimal neighbours, taken as doubles
    (``floor(x*10^d)/10^d`` and ``ceil(x*10^d)/10^d``), pick the one closer to
    ``x``; on an exact tie pick the one whose last digit is even. Spark's
    ``round`` (half-up on decimal text) and ``bround`` (half-even on decimal
    text) both differ from it. NULL stays NULL; NaN and infinities pass.

    Written without branches over the neighbours: the chosen neighbour is
    ``(floor + (ceil - floor) * pick) / 10^d`` with ``pick`` in {0, 1}, so the
    shared terms are evaluated once per row and the generated code stays
    small when many columns are rounded in one projection.
    """
    if isinstance(c, str):
        return F.expr(_round_r_sql(quote(c), digits))
    x = as_col(c)
    p = F.lit(float(10 ** digits))
    s = x * p
    lo_i = F.floor(s)
    hi_i = F.ceil(s)
    down = x - lo_i / p
    up = hi_i / p - x
    pick = ((down > up) | ((down == up) & (lo_i % 2 != 0))).cast("long")
    nearest = (lo_i + (hi_i - lo_i) * pick) / p
    return F.when(F.abs(s) < F.lit(_EXACT_LIMIT), nearest).otherwise(x)


def _round_r_sql(x: str, digits: int) -> str:
    """The same expression as SQL text (one call to build, for named columns)."""
    p = f"{float(10 ** digits)!r}D"
    s = f"({x} * {p})"
    lo_i, hi_i = f"floor({s})", f"ceil({s})"
    down, up = f"({x} - {lo_i} / {p})", f"({hi_i} / {p} - {x})"
    pick = f"CAST(({down} > {up}) OR ({down} = {up} AND {lo_i} % 2 != 0) AS BIGINT)"
    return (f"CASE WHEN abs({s}) < {_EXACT_LIMIT!r}D "
            f"THEN ({lo_i} + ({hi_i} - {lo_i}) * {pick}) / {p} ELSE {x} END")


def _large_text(d: Column) -> Column:
    """All digits of an integral double below 2**118. Divided by a power of two
    that its last bit reaches it is exact as a long; the product is too."""
    out = F.lit(None).cast("string")
    for k in (55, 44, 33, 22, 11, 0):
        small = F.when(F.abs(d) < float(2 ** (63 + k)), d / float(2 ** k)).otherwise(0.0)
        exact = (small.cast("long").cast("decimal(20,0)")
                 * F.lit(Decimal(2 ** k)).cast("decimal(18,0)")).cast("string")
        out = F.when(F.abs(d) < float(2 ** (63 + k)), exact).otherwise(out)
    return out


def number_text(c, integral: bool = False) -> Column:
    """Format a number as published text.

    Integral values print all their digits, without a fractional part and
    without exponent (``10``, ``17116550``); other values print their shortest
    round-trip digits (``86.50999999999999``), in plain notation where Java
    would use an exponent. Below 1e-15, and from 2**118 on, the exponent form
    is kept. NULL stays NULL (the sink writes ``NA``). ``integral`` says that
    the column is of an integer type and needs no double.
    """
    x = as_col(c)
    if integral:
        return x.cast("string")
    d = x.cast("double")
    a = F.abs(d)
    plain = F.regexp_replace(
        F.regexp_replace(F.when(a < F.lit(1e15), d).cast("decimal(38,15)").cast("string"), r"0+$", ""),
        r"\.$", "")
    short = d.cast("string")
    return (F.when(F.isnan(d) | (a >= F.lit(float(2 ** 118))), short)
            .when(a >= F.lit(1e15), _large_text(d))
            .when(d == F.floor(d), F.floor(d).cast("string"))
            .when((a < F.lit(1e-15)) | ~short.contains("E"), short)
            .otherwise(plain))
