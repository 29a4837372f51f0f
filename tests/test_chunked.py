"""Lags, running totals and places by parts, against the windowed forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pressio.operators import (lagged_increment, lagged_increment_by_month, ranked,
                               running_total, running_total_by_month)

SCHEMA = "entity string, day date, v long, note string"


def series(seed=5):
    """One entity with about 90% of the rows, others with gaps of months and
    months of one or two rows, a NULL entity, NULL values late in a series."""
    rnd, rows = random.Random(seed), []
    first = dt.date(2020, 1, 1)
    rows += [("hot", first + dt.timedelta(days=i), rnd.randrange(-50, 500), "h") for i in range(1500)]
    for name in ("a", "b.c", None):
        at = first
        for i in range(50):
            at += dt.timedelta(days=rnd.choice([1, 2, 20, 40, 75]))
            rows.append((name, at, None if name == "a" and i == 30 else rnd.randrange(100), None))
    rows.append(("one", first, 7, "single"))
    rnd.shuffle(rows)
    return rows


def canon(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("n", [1, 3, 7, 40])
def test_lag_by_month_equals_windowed(spark, n):
    df = spark.createDataFrame(series(), SCHEMA)
    want = lagged_increment(df, "entity", "day", "v", n, "lag", "inc")
    got = lagged_increment_by_month(df, "entity", "day", "v", n, "lag", "inc")
    assert got.columns == want.columns
    assert canon(got) == canon(want)


def test_running_total_by_month_equals_windowed(spark):
    df = spark.createDataFrame(series(), SCHEMA)
    want = running_total(df, "entity", "day", "v", "total")
    got = running_total_by_month(df, "entity", "day", "v", "total")
    assert got.columns == want.columns
    assert canon(got) == canon(want)


def test_columns_of_any_name(spark):
    df = spark.createDataFrame(series(), SCHEMA).select(
        "*", *[F.lit(1).alias(c) for c in ("month", "halo", "nth", "e", "m", "start", "later", "before", "broken", "at")])
    assert canon(lagged_increment_by_month(df, "entity", "day", "v", 7, "lag", "inc")) == canon(
        lagged_increment(df, "entity", "day", "v", 7, "lag", "inc"))
    assert canon(running_total_by_month(df, "entity", "day", "v", "total")) == canon(
        running_total(df, "entity", "day", "v", "total"))
    assert ranked(df, [F.col("entity"), F.col("day")]).columns == df.columns + ["rank"]


def test_no_window_holds_a_history(spark):
    """Windows over rows are by entity and month; by entity alone only rows
    of one month each are ordered."""
    df = spark.createDataFrame(series(), SCHEMA)
    for out in (running_total_by_month(df, "entity", "day", "v", "total"),
                lagged_increment_by_month(df, "entity", "day", "v", 7, "lag", "inc")):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.splitlines() if "Window [" in line]
        assert windows and not [w for w in windows if "[day#" in w and "month#" not in w]


def test_repeated_key_fails(spark):
    day = dt.date(2020, 1, 5)
    df = spark.createDataFrame([("a", day, 1, ""), ("a", day, 2, "")], SCHEMA)
    for out in (running_total_by_month(df, "entity", "day", "v", "total"),
                lagged_increment_by_month(df, "entity", "day", "v", 1, "lag", "inc")):
        with pytest.raises(Exception, match="duplicate"):
            out.collect()


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert running_total_by_month(df, "entity", "day", "v", "total").collect() == []
    assert lagged_increment_by_month(df, "entity", "day", "v", 7, "lag", "inc").collect() == []
    assert ranked(df, [F.col("v")]).collect() == []


def test_ranked_over_many_ranges(spark):
    df = spark.range(0, 30000, numPartitions=7).select(
        F.xxhash64("id").alias("x"), (F.col("id") % 3).alias("g"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ranked(df, [F.col("g").desc(), F.col("x").asc()])
        rows = got.orderBy("rank").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert [r["rank"] for r in rows] == list(range(1, 30001))
    assert [(r["g"], r["x"]) for r in rows] == sorted(((r["g"], r["x"]) for r in rows), key=lambda t: (-t[0], t[1]))
