"""Randomised invariants on generated series."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pressio.operators import lagged_increment, pivot_wide, running_total, with_total

ENT = st.sampled_from(["A", "B.c", "d'E", "Vallée"])
ROWS = st.lists(st.tuples(st.integers(0, 40), ENT, st.one_of(st.none(), st.integers(0, 1000))),
                min_size=1, max_size=60, unique_by=lambda r: (r[0], r[1]))
SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, rows):
    base = dt.date(2021, 12, 20)
    return spark.createDataFrame([(base + dt.timedelta(days=d), e, x) for d, e, x in rows],
                                 "d date, e string, x long")


@SETTINGS
@given(ROWS)
def test_total_equals_strict_sum(spark, rows):
    out = with_total(frame(spark, rows), "d", "e", ["x"], "T").collect()
    tot = {r["d"]: r["x"] for r in out if r["e"] == "T"}
    by = {}
    for r in out:
        if r["e"] != "T":
            by.setdefault(r["d"], []).append(r["x"])
    for d, xs in by.items():
        assert tot[d] == (None if any(x is None for x in xs) else sum(xs))


@SETTINGS
@given(ROWS, st.integers(1, 8))
def test_partitioning_does_not_change_results(spark, rows, n):
    df = frame(spark, rows)
    a = sorted(map(tuple, running_total(lagged_increment(df, "e", "d", "x", 7, "l", "i"),
                                        "e", "d", "x", "c").collect()))
    b = sorted(map(tuple, running_total(lagged_increment(df.repartition(n), "e", "d", "x", 7,
                                                         "l", "i"), "e", "d", "x", "c").collect()))
    assert a == b


@SETTINGS
@given(ROWS)
def test_lag_null_exactly_first_seven(spark, rows):
    out = lagged_increment(frame(spark, rows), "e", "d", "x", 7, "l", "i")
    w = out.withColumn("rn", F.row_number().over(
        __import__("pyspark.sql", fromlist=["Window"]).Window.partitionBy("e").orderBy("d")))
    for r in w.collect():
        if r["rn"] <= 7:
            assert r["l"] is None


@SETTINGS
@given(ROWS)
def test_pivot_then_unpivot_is_identity(spark, rows):
    df = frame(spark, rows).filter(F.col("x").isNotNull()).withColumn("v", F.col("x").cast("double"))
    if df.count() == 0:
        return
    wide = pivot_wide(df, ["d"], "e", "v")
    names = [c for c in wide.columns if c != "d"]
    back = set()
    for r in wide.collect():
        for n in names:
            if r[n] is not None:
                back.add((r["d"], n, r[n]))
    assert back == {(r["d"], r["e"], r["v"]) for r in df.collect()}
