"""Operators on synthetic edge rows (FIXTURES §6)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pressio.operators import (compare_periods, drop_incomplete, drop_last_key,
                               lagged_increment, mean_by, natural_join, pivot_wide,
                               recode, relabel, running_total, sum_by, sum_with_total,
                               with_grand_total, with_total)

D = dt.date


def test_with_total_null_semantics(spark):
    df = spark.createDataFrame(
        [(D(2021, 1, 1), "A", 1), (D(2021, 1, 1), "B", 2), (D(2021, 1, 2), "A", None),
         (D(2021, 1, 2), "B", 5), (None, "A", 9)], "d date, e string, x long")
    out = {(r["d"], r["e"]): r["x"] for r in with_total(df, "d", "e", ["x"], "T").collect()}
    assert out[(D(2021, 1, 1), "T")] == 3
    assert out[(D(2021, 1, 2), "T")] is None          # one NULL -> NULL total
    assert (None, "A") not in out and len(out) == 6   # NULL date dropped


def test_with_total_rejects_label_and_duplicates(spark):
    df = spark.createDataFrame([(D(2021, 1, 1), "T", 1)], "d date, e string, x long")
    with pytest.raises(Exception, match="total label"):
        with_total(df, "d", "e", ["x"], "T").collect()
    dup = spark.createDataFrame([(D(2021, 1, 1), "A", 1), (D(2021, 1, 1), "A", 2)],
                                "d date, e string, x long")
    with pytest.raises(Exception, match="duplicate"):
        with_total(dup, "d", "e", ["x"], "T").collect()


def test_grand_total_and_grouping_sets(spark):
    dim = spark.createDataFrame([("A", 1), ("B.x", 2)], "e string, p long")
    got = {r["e"]: r["p"] for r in with_grand_total(dim, "e", ["p"], "T").collect()}
    assert got == {"A": 1, "B.x": 2, "T": 3}
    v = spark.createDataFrame([(D(2021, 1, 1), "A", 1), (D(2021, 1, 1), "A", 2),
                               (D(2021, 1, 1), "B", 4)], "d date, e string, t long")
    got = {r["e"]: r["n"] for r in sum_with_total(v, "d", "e", "t", "n", "T").collect()}
    assert got == {"A": 3, "B": 4, "T": 7}


def test_lag_counts_rows_not_days(spark):
    days = [D(2021, 1, i) for i in (1, 2, 3, 5, 8, 9, 10, 11, 12, 20)]
    df = spark.createDataFrame([(d, "A", i * 10) for i, d in enumerate(days)] +
                               [(D(2021, 1, 1), "short", 1)], "d date, e string, x long")
    out = lagged_increment(df, "e", "d", "x", 7, "lag", "inc").orderBy("e", "d").collect()
    a = [r for r in out if r["e"] == "A"]
    assert [r["lag"] for r in a] == [None] * 7 + [0, 10, 20]
    assert [r["inc"] for r in a][7:] == [70, 70, 70]
    assert [r["lag"] for r in out if r["e"] == "short"] == [None]


def test_lag_rejects_duplicate_key(spark):
    df = spark.createDataFrame([(D(2021, 1, 1), "A", 1), (D(2021, 1, 1), "A", 2)],
                               "d date, e string, x long")
    with pytest.raises(Exception, match="duplicate"):
        lagged_increment(df, "e", "d", "x", 7, "lag", "inc").collect()


def test_running_total_poisoned_by_null(spark):
    df = spark.createDataFrame([(D(2021, 1, i), "A", v) for i, v in ((1, 1), (2, None), (3, 4))],
                               "d date, e string, x long")
    got = [r["c"] for r in running_total(df, "e", "d", "x", "c").orderBy("d").collect()]
    assert got == [1, None, None]


def test_natural_join_null_safe_and_right(spark):
    left = spark.createDataFrame([("A", 1), (None, 2), ("B", 3)], "e string, l long")
    right = spark.createDataFrame([("A", 10), (None, 20), ("C", 30)], "e string, r long")
    lj = {(r["e"], r["l"]): r["r"] for r in natural_join(left, right, "left").collect()}
    assert lj == {("A", 1): 10, (None, 2): 20, ("B", 3): None}
    rj = natural_join(left, right, "right")
    assert rj.columns == ["e", "l", "r"]
    got = {(r["e"], r["r"]): r["l"] for r in rj.collect()}
    assert got == {("A", 10): 1, (None, 20): 2, ("C", 30): None}


def test_compare_periods_keeps_t1_entities(spark):
    df = spark.createDataFrame([(D(2022, 5, 17), "A", 2.0), (D(2022, 5, 16), "A", 2.5),
                                (D(2022, 5, 16), "B", 1.0), (D(2022, 5, 17), "C", 3.0)],
                               "d date, e string, v double")
    out = compare_periods(df, "e", "d", "v", D(2022, 5, 17), D(2022, 5, 16), "t", "t1")
    assert out.columns == ["d", "e", "t", "t1"]
    got = {r["e"]: tuple(r) for r in out.collect()}
    assert got == {"B": (None, "B", None, 1.0), "A": (D(2022, 5, 17), "A", 2.0, 2.5)}


def test_relabel_last_label_wins_and_recode(spark):
    df = spark.createDataFrame([("Friuli-Venezia Giulia", 1.0), (None, 2.0), ("Lazio", 3.0)],
                               "r string, s double")
    out = relabel(df, [("First", "s"), ("Regione", "r"), ("Last", "s")])
    assert out.columns == ["Regione", "Last"]
    from pressio.config import REFERENCE_RECODE
    got = [r["r"] for r in recode(df, "r", REFERENCE_RECODE).collect()]
    assert got == ["Friuli Venezia Giulia", None, "Lazio"]


def test_pivot_names_with_dots_and_duplicates(spark):
    df = spark.createDataFrame([(D(2022, 1, 1), "P.A. Bolzano", 1.0),
                                (D(2022, 1, 1), "Valle d'Aosta", 2.0),
                                (D(2022, 1, 2), "P.A. Bolzano", 3.0)], "d date, e string, v double")
    wide = pivot_wide(df, ["d"], "e", "v", sort_names=True)
    assert wide.columns == ["d", "P.A. Bolzano", "Valle d'Aosta"]
    got = {r["d"]: (r["P.A. Bolzano"], r["Valle d'Aosta"]) for r in wide.collect()}
    assert got == {D(2022, 1, 1): (1.0, 2.0), D(2022, 1, 2): (3.0, None)}
    dup = df.union(df.limit(1))
    with pytest.raises(Exception, match="duplicate"):
        pivot_wide(dup, ["d"], "e", "v", names=["P.A. Bolzano", "Valle d'Aosta"]).collect()


def test_pivot_first_appearance_order(spark):
    df = spark.createDataFrame([(2, 2022, "B", 1.0), (1, 2022, "C", 1.0), (1, 2021, "A", 1.0),
                                (30, 2021, "D", 1.0)], "week int, year int, e string, v double")
    wide = pivot_wide(df, ["week", "year"], "e", "v", sort_names=False, order_by=["week", "year"])
    assert wide.columns == ["week", "year", "A", "C", "B", "D"]


def test_drop_last_key_and_incomplete(spark):
    df = spark.createDataFrame([(53, 2021, 1.0), (20, 2022, None), (1, 2022, 3.0)],
                               "week int, year int, v double")
    assert sorted((r["week"], r["year"]) for r in drop_last_key(df, ["week", "year"]).collect()) \
        == [(1, 2022), (20, 2022)]
    nan = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "v double")
    assert drop_incomplete(nan).count() == 1


def test_mean_by_methods(spark):
    df = spark.createDataFrame([("a", 2.67), ("a", 2.68), ("b", 1.0), ("b", None)],
                               "k string, x double")
    for method in ("avg", "decimal", "exact"):
        got = {r["k"]: r["m"] for r in mean_by(df, ["k"], "x", "m", method=method).collect()}
        assert got["b"] is None and abs(got["a"] - 2.675) < 1e-12


def test_sum_by_collapses_non_numeric(spark):
    df = spark.createDataFrame([("d", "A", "x", "12-19", 1, 2), ("d", "A", "x", "20-29", 3, None)],
                               "d string, e string, s string, age string, a long, b long")
    out = sum_by(df, ["d", "e", "s"])
    assert out.columns == ["d", "e", "s", "a", "b"]
    r = out.first()
    assert r["a"] == 4 and r["b"] is None


def test_exact_mean_of_any_group_size(spark):
    from fractions import Fraction
    import random
    rnd = random.Random(3)
    vals = {n: [rnd.uniform(-1e6, 1e6) * rnd.choice([1, 1e-9, 1e6]) for _ in range(n)] for n in (1, 2, 7, 400)}
    df = spark.createDataFrame([(n, v) for n, vs in vals.items() for v in vs], "k int, x double")
    got = {r["k"]: r["m"] for r in mean_by(df, ["k"], "x", "m", method="exact").collect()}
    for n, vs in vals.items():
        assert got[n] == float(sum(map(Fraction, vs)) / n)
    big = spark.range(1_000_000).select(F.lit("a").alias("k"), (F.col("id") / 8).alias("x"))
    assert mean_by(big, ["k"], "x", "m", method="exact").first()["m"] == 999_999 / 16


def test_exact_mean_of_infinities_and_large_values(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("i", inf), ("i", 1.0), ("m", inf), ("m", -inf), ("n", nan), ("n", 1.0), ("l", 1e300), ("l", 1e300),
            ("z", None), ("z", 1.0), ("-", -inf)]
    got = {r["k"]: r["m"] for r in mean_by(spark.createDataFrame(rows, "k string, x double"), ["k"], "x", "m",
                                           method="exact").collect()}
    assert got["i"] == inf and got["-"] == -inf and got["l"] == 1e300 and got["z"] is None
    assert got["m"] != got["m"] and got["n"] != got["n"]


def test_exact_mean_is_order_independent(spark):
    vals = [-8.92, -35.42, 0.12, 13.01, -5.37, 21.01]  # mean is the decimal tie -2.595
    a = spark.createDataFrame([("k", v) for v in vals], "k string, x double")
    b = spark.createDataFrame([("k", v) for v in reversed(vals)], "k string, x double").repartition(3)
    ma = mean_by(a, ["k"], "x", "m", method="exact")
    assert ma.first()["m"] == mean_by(b, ["k"], "x", "m", method="exact").first()["m"]
    assert "collect_list" not in ma._jdf.queryExecution().executedPlan().toString()


def test_recode_is_one_form_at_every_length(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("k70",)], "c string")
    short = [("a", "1"), ("a", "2")]
    long = short + [(f"k{i}", f"v{i}") for i in range(100)]
    assert [r.c for r in recode(df, "c", short).collect()] == ["1", "b", None, "k70"]
    assert [r.c for r in recode(df, "c", long).collect()] == ["1", "b", None, "v70"]


def test_pivot_refuses_names_not_in_the_list(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], "i int, n string, v double")
    with pytest.raises(Exception, match="not in the given list"):
        pivot_wide(df, ["i"], "n", "v", names=["a"]).collect()


def test_lag_is_missing_for_exactly_the_first_rows(spark):
    rows = [(D(2021, 1, 1) + dt.timedelta(days=2 * i), e, i) for e, n in (("A", 30), ("B", 7), ("C", 8))
            for i in range(n)]
    out = lagged_increment(spark.createDataFrame(rows, "d date, e string, x long"), "e", "d", "x", 7, "lag", "inc")
    for e, n in (("A", 30), ("B", 7), ("C", 8)):
        lags = [r["lag"] for r in out.filter(F.col("e") == e).orderBy("d").collect()]
        assert lags == [None] * min(7, n) + list(range(n - 7))


def test_compare_periods_refuses_repeated_entities(spark):
    df = spark.createDataFrame([(D(2022, 5, 16), "A", 1.0), (D(2022, 5, 16), "A", 2.0)],
                               "d date, e string, v double")
    with pytest.raises(Exception, match="duplicate"):
        compare_periods(df, "e", "d", "v", D(2022, 5, 17), D(2022, 5, 16), "t", "t1").collect()
