"""Column functions: R rounding, strict aggregates, dates, ratio, number text."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pressio.functions import (number_text, parse_day, ratio, round_r, strict_mean,
                               strict_running_sum, strict_sum, week_label, week_number)


def one_col(spark, values, typ="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


# Published rounding witnesses: unrounded double -> published text.
WITNESSES = [
    (282.605, 2, 282.6), (4533.905, 2, 4533.9), (2136.605, 2, 2136.6),
    (337.965, 2, 337.96), (2912.705, 2, 2912.7), (29669.865, 2, 29669.87),
]


@pytest.mark.parametrize("x,d,want", WITNESSES)
def test_round_r_witnesses(spark, x, d, want):
    got = one_col(spark, [x]).select(round_r("x", d).alias("r")).first()["r"]
    assert got == want


def test_round_r_differs_from_spark_round(spark):
    df = one_col(spark, [w[0] for w in WITNESSES])
    rows = df.select(round_r("x", 2).alias("r"), F.round("x", 2).alias("h"),
                     F.bround("x", 2).alias("e")).collect()
    assert [r["r"] for r in rows] == [w[2] for w in WITNESSES]
    assert sum(r["r"] != r["h"] for r in rows) == 5
    assert sum(r["r"] != r["e"] for r in rows) == 1


def test_round_r_edges(spark):
    df = one_col(spark, [None, 2.5, 3.5, -2.5, -2.675, 0.125, 1e17, 12.0])
    got = [r["r"] for r in df.select(round_r("x", 0).alias("r")).collect()]
    assert got[:4] == [None, 2.0, 4.0, -2.0]
    assert got[6:] == [1e17, 12.0]
    got2 = [r["r"] for r in df.select(round_r("x", 2).alias("r")).collect()]
    assert got2[5] == 0.12  # exact binary tie -> even digit
    assert got2[4] == -2.67 or got2[4] == -2.68


def test_ratio_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (-1.0, 0.0), (3.0, 2.0), (None, 1.0)],
                               "a double, b double")
    null = [r["q"] for r in df.select(ratio("a", "b").alias("q")).collect()]
    assert null == [None, None, None, 1.5, None]
    inf = [r["q"] for r in df.select(ratio("a", "b", "inf").alias("q")).collect()]
    assert inf[0] == float("inf") and inf[2] == float("-inf") and inf[1] != inf[1]


def test_strict_aggregates(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2), ("b", 3)], "k string, x long")
    rows = {r["k"]: r for r in df.groupBy("k").agg(strict_sum("x").alias("s"),
                                                   strict_mean("x").alias("m")).collect()}
    assert rows["a"]["s"] is None and rows["a"]["m"] is None
    assert rows["b"]["s"] == 5 and rows["b"]["m"] == 2.5


def test_strict_running_sum(spark):
    df = spark.createDataFrame([(1, 1), (2, None), (3, 4)], "i int, x long")
    w = Window.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    got = [r["c"] for r in df.select(strict_running_sum("x", w).alias("c")).orderBy("i").collect()]
    assert got == [1, None, None]


def test_parse_day(spark):
    values = ["2020-02-24T18:00:00", "2020-02-24 18:00:00", "20200224", "2021-02-30", "", None,
              "2020/02/24"]
    got = [r["d"] for r in one_col(spark, values, "string")
           .select(parse_day("x").alias("d")).collect()]
    d = dt.date(2020, 2, 24)
    assert got == [d, d, d, None, None, None, d]


def test_week_number_and_label(spark):
    days = [dt.date(2021, 12, 31), dt.date(2020, 2, 29), dt.date(2022, 1, 1), dt.date(2022, 1, 7),
            dt.date(2022, 1, 8)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select(week_number("d").alias("w"), F.year("d").alias("y")).collect()
    assert [r["w"] for r in rows] == [53, 9, 1, 1, 2]
    lab = spark.createDataFrame([(2022, 1), (2022, 20), (2021, 27), (2021, 52)], "y int, w int")
    got = [r["l"] for r in lab.select(week_label("y", "w").alias("l")).collect()]
    assert got == [dt.date(2022, 1, 3), dt.date(2022, 5, 16), dt.date(2021, 7, 5),
                   dt.date(2021, 12, 27)]


def test_week_label_matches_strftime(spark):
    """Monday of Sunday-first week w equals the %Y-%U-%u reading for 2015-2028."""
    pairs = [(y, w) for y in range(2015, 2029) for w in range(1, 54)]
    want = {}
    for y, w in pairs:
        try:
            want[(y, w)] = dt.datetime.strptime(f"{y}-{w}-1", "%Y-%U-%u").date()
        except ValueError:
            pass
    df = spark.createDataFrame(pairs, "y int, w int")
    got = {(r["y"], r["w"]): r["l"] for r in
           df.select("y", "w", week_label("y", "w").alias("l")).collect()}
    assert all(got[k] == v for k, v in want.items())


def test_number_text(spark):
    df = one_col(spark, [10.0, 17116550.0, 86.50999999999999, None, 0.05, 123456789.25,
                         -3.64, 0.00012, 1e23, 1e-20, 2.0 ** 60])
    got = [r["t"] for r in df.select(number_text("x").alias("t")).collect()]
    assert got == ["10", "17116550", "86.50999999999999", None, "0.05", "123456789.25",
                   "-3.64", "0.00012", "99999999999999991611392", "1.0E-20",
                   "1152921504606846976"]


def test_exact_integers_as_text(spark):
    from decimal import Decimal
    vals = [9007199254740993, 2 ** 62 + 1, -(2 ** 63)]
    df = spark.createDataFrame([(v,) for v in vals], "x long")
    assert [r["t"] for r in df.select(number_text("x", integral=True).alias("t")).collect()] == [str(v) for v in vals]
    doubles = [2.0 ** k * m for k in (52, 61, 63, 70, 80, 90, 100, 110) for m in (1, -1.5, 1.9999999)]
    df = spark.createDataFrame([(v,) for v in doubles], "x double")
    got = [r["t"] for r in df.select(number_text("x").alias("t")).collect()]
    assert [Decimal(t) for t in got] == [Decimal(v) for v in doubles]
    assert not any("E" in t for t in got)


def test_days_as_feeds_spell_them(spark):
    import datetime as dt
    from pressio.functions import parse_day, rejected_day
    want = {"2009-01-04": dt.date(2009, 1, 4), "2009-1-4": dt.date(2009, 1, 4), "2009.01.04": dt.date(2009, 1, 4),
            "2009 01 03": dt.date(2009, 1, 3), "20090104": dt.date(2009, 1, 4), "2009/1/04": dt.date(2009, 1, 4),
            "2020-02-24T18:00:00": dt.date(2020, 2, 24), "2020-02-24 18:00:00": dt.date(2020, 2, 24),
            "2021-02-30": None, "x": None, "200901045": None, "": None, None: None, " 2009-01-04 ": dt.date(2009, 1, 4)}
    df = spark.createDataFrame([(t,) for t in want], "t string")
    got = {r["t"]: (r["d"], r["r"]) for r in df.select("t", parse_day("t").alias("d"),
                                                        rejected_day("t").alias("r")).collect()}
    assert {t: d for t, (d, _) in got.items()} == want
    assert {t for t, (_, r) in got.items() if r} == {"2021-02-30", "x", "200901045"}


def test_division_by_zero_as_ieee(spark):
    import math
    from pressio.functions import ratio
    inf, nan = float("inf"), float("nan")
    rows = [(1.0, 0.0), (-1.0, 0.0), (1.0, -0.0), (-1.0, -0.0), (0.0, 0.0), (nan, 0.0), (inf, -0.0), (None, 0.0),
            (1.0, None), (1.0, nan), (6.0, 3.0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a double, b double")
    got = [r["q"] for r in df.orderBy("i").select(ratio("a", "b", "inf").alias("q")).collect()]
    want = [inf, -inf, -inf, inf, nan, nan, -inf, None, None, nan, 2.0]
    assert all(g == w or (w is not None and g is not None and math.isnan(g) and math.isnan(w))
               for g, w in zip(got, want))
