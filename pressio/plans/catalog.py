"""Registered queries over the driver's tables (one per operator group).

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables. The matching DuckDB SQL is in :mod:`pressio.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions import (number_text, parse_day, rejected_day, round_r, strict_mean,
                         strict_running_sum, strict_sum, week_label, week_number)
from ..operators import (date_range, drop_incomplete, drop_last_key,
                         lagged_increment, lagged_increment_by_month, natural_join,
                         pivot_wide, ranked, recode, running_total,
                         running_total_by_month, sum_with_total, with_total)
from ..sources import adapters as A
from ..session import drop_folder, scratch_folder
from ..sources.io import (REJECTED, conformed_cell, months, publish_csv, read_result,
                          read_with_rejects, reject_counts, write_result)
from . import result as P
from . import products as R

CFG = A.DRIVER

# A four-name recode on the driver's nations (F10): names with a dot, an
# apostrophe, an accent and a hyphen, as in the published feed.
DRIVER_RECODE = (
    ("NATION_1", "P.A. Nation 1"),
    ("NATION_2", "Nation d'Two"),
    ("NATION_3", "Nation Vallée 3"),
    ("NATION_4", "Nation-Four"),
)
# Derived NULLs for the strict-aggregate checks: quantity 13 becomes NULL.
NULL_QUANTITY = 13


def _inputs(spark: SparkSession, sf: str):
    return (A.incidence_raw(spark, sf), A.vaccination_raw(spark, sf),
            A.dimension_raw(spark, sf))


def full_result(spark: SparkSession, sf: str) -> DataFrame:
    return P.full_result(*_inputs(spark, sf), CFG)


def _index(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """Day, entity and index of the full result (and ``more``), materialised
    for the queries that read them more than once or filter on a KPI."""
    return P.materialise(full_result(spark, sf).select(CFG.date, CFG.entity, *more, CFG.index))


def conform_incidence(spark, sf):
    return P.prepare_incidence(A.incidence_raw(spark, sf), CFG)


def entity_recode(spark, sf):
    conformed = P.conform_vaccinations(A.vaccination_raw(spark, sf), CFG)
    return recode(conformed, CFG.entity, DRIVER_RECODE)


def dose_sums(spark, sf):
    return P.dose_sums(P.conform_vaccinations(A.vaccination_raw(spark, sf), CFG), CFG)


def completed_courses(spark, sf):
    return P.prepare_vaccinations(A.vaccination_raw(spark, sf), CFG)


def incidence_with_total(spark, sf):
    prepared = conform_incidence(spark, sf)
    return with_total(prepared, CFG.date, CFG.entity, CFG.incidence_measures,
                      CFG.total_label)


def vaccination_with_total(spark, sf):
    return sum_with_total(completed_courses(spark, sf), CFG.date, CFG.entity,
                          CFG.course_total, CFG.new_vaccinated, CFG.total_label)


def dimension_with_total(spark, sf):
    return P.dimension_with_total(A.dimension_raw(spark, sf), CFG)


def lag_increment(spark, sf):
    return lagged_increment(incidence_with_total(spark, sf), CFG.entity, CFG.date,
                            CFG.cases_cumulative, CFG.delta, CFG.cases_lag,
                            CFG.increment)


def running_total_q(spark, sf):
    return running_total(vaccination_with_total(spark, sf), CFG.entity, CFG.date,
                         CFG.new_vaccinated, CFG.vaccinated)


def lag_increment_by_month(spark, sf):
    """W1, W2 with months as tasks and a halo of rows between them."""
    return lagged_increment_by_month(incidence_with_total(spark, sf), CFG.entity, CFG.date,
                                     CFG.cases_cumulative, CFG.delta, CFG.cases_lag,
                                     CFG.increment)


def running_total_by_month_q(spark, sf):
    """W3 as a prefix scan over months."""
    return running_total_by_month(vaccination_with_total(spark, sf), CFG.entity, CFG.date,
                                  CFG.new_vaccinated, CFG.vaccinated)


def _lines_with_nulls(spark, sf):
    li = A.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    q = F.when(F.col("l_quantity") != NULL_QUANTITY, F.col("l_quantity").cast("bigint"))
    return li.select("l_orderkey", "l_linenumber", q.alias("qty"))


def strict_sum_q(spark, sf):
    return (_lines_with_nulls(spark, sf).groupBy("l_orderkey")
            .agg(strict_sum("qty").alias("sum_qty"), F.count(F.lit(1)).alias("n_lines")))


def strict_mean_q(spark, sf):
    return (_lines_with_nulls(spark, sf).groupBy("l_orderkey")
            .agg(strict_mean("qty").alias("mean_qty")))


def strict_cumsum_q(spark, sf):
    """Strict sum per (order, line number), then its strict running sum in
    line-number order within the order (line numbers repeat in the data, so
    the sum first makes the order total)."""
    per_line = (_lines_with_nulls(spark, sf).groupBy("l_orderkey", "l_linenumber")
                .agg(strict_sum("qty").alias("qty")))
    w = (Window.partitionBy("l_orderkey").orderBy("l_linenumber")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return per_line.withColumn("cum_qty", strict_running_sum("qty", w))


def join_dimension(spark, sf):
    return P.join_dimension(lag_increment(spark, sf), dimension_with_total(spark, sf), CFG)


def join_right(spark, sf):
    return natural_join(join_dimension(spark, sf), running_total_q(spark, sf), "right")


def round_parity(spark, sf):
    li = A.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    x = F.col("l_extendedprice") * F.col("l_discount") / F.lit(3.0)
    half = F.col("l_extendedprice") / F.lit(2.0)
    return li.select("l_orderkey", "l_linenumber",
                     round_r(x, 0).alias("r0"), round_r(x, 2).alias("r2"),
                     round_r(x, 4).alias("r4"), round_r(half, 2).alias("half2"))


def _ship_days(spark, sf):
    li = A.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("d"))
    return li.distinct()


def week_number_label(spark, sf):
    days = _ship_days(spark, sf)
    wk = days.select("d", week_number("d").alias("week"), F.year("d").alias("year"))
    return wk.withColumn("week_label", week_label("year", "week"))


def date_filters(spark, sf):
    return date_range(conform_incidence(spark, sf), CFG.date,
                      CFG.day(CFG.last_days), CFG.day(CFG.snapshot_lag))


def drop_incomplete_q(spark, sf):
    return drop_incomplete(_index(spark, sf, CFG.increment, "incidenza"))


def drop_last_key_q(spark, sf):
    return drop_last_key(week_number_label(spark, sf), ["week", "year"])


def weekly_mean_long(spark, sf):
    return R.weekly_long(_index(spark, sf), CFG)


def weekly_wide(spark, sf):
    long = P.materialise(R.weekly_long(full_result(spark, sf), CFG))
    return R.weekly_wide_of(long, CFG)


def daily_wide(spark, sf):
    days = date_range(full_result(spark, sf).select(CFG.date, CFG.entity, CFG.index), CFG.date,
                      CFG.day(CFG.last_days), CFG.day(CFG.snapshot_lag))
    return R.daily_wide(P.materialise(days), CFG)


def events_daily_wide(spark, sf):
    """The daily pivot on the dense events table: one column per event type,
    the day's summed value rounded to 2 decimals."""
    ev = A.table(spark, sf, "events").select("ts", "event_type", "value")
    daily = (ev.groupBy(F.to_date("ts").alias("day"), F.col("event_type"))
             .agg(round_r(F.sum("value"), 2).alias("value")))
    return pivot_wide(daily, ["day"], "event_type", "value", sort_names=True)


def weighted_count_q(spark, sf):
    return ranked(R.population_by_entity(A.population_raw(spark, sf), CFG), R.population_order(CFG))


def feed_cells(spark, sf):
    """Text cells as feeds spell numbers, days and missing values, written
    from lineitem, read back as the incidence feed's types (S1-S3, D1)."""
    li = A.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                               "l_partkey", "l_shipdate")
    kind = F.col("l_linenumber") % 5
    whole = F.col("l_quantity").cast("bigint").cast("string")
    number = (F.when(kind == 0, whole).when(kind == 1, F.concat(whole, F.lit(".0")))
              .when(kind == 2, F.concat(whole, F.lit("e2"))).when(kind == 3, F.lit("NA"))
              .otherwise(F.concat(F.lit(" "), whole)))
    cells = li.select("l_orderkey", "l_linenumber", number.alias("totale_casi"),
                      F.when(kind == 4, F.lit("x")).otherwise(F.col("l_partkey").cast("string"))
                      .alias("terapia_intensiva"),
                      F.when(kind == 2, F.lit("")).otherwise(F.lit(" a ")).alias("note"))
    return cells.select("l_orderkey", "l_linenumber",
                        *[conformed_cell(c, t).alias(c) for c, t in (
                            ("totale_casi", LongType()), ("terapia_intensiva", LongType()),
                            ("note", StringType()))])


def date_spellings(spark, sf):
    """Ship days in seven spellings, some impossible, parsed."""
    li = A.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    d, kind = F.to_date("l_shipdate"), (F.col("l_orderkey") + F.col("l_linenumber")) % 8
    spelled = (F.when(kind == 0, F.date_format(d, "yyyy-MM-dd"))
               .when(kind == 1, F.date_format(d, "yyyy-M-d")).when(kind == 2, F.date_format(d, "yyyy.MM.dd"))
               .when(kind == 3, F.date_format(d, "yyyy MM dd")).when(kind == 4, F.date_format(d, "yyyyMMdd"))
               .when(kind == 5, F.concat(F.date_format(d, "yyyy/MM/dd"), F.lit("T18:00:00")))
               .when(kind == 6, F.concat(F.year(d).cast("string"), F.lit("-02-30")))
               .otherwise(F.lit(None).cast("string")))
    rows = li.select("l_orderkey", "l_linenumber", spelled.alias("text"))
    return rows.select("*", parse_day("text").alias("day"), F.coalesce(
        rejected_day("text"), F.lit(False)).alias("rejected"))


FEED = StructType([StructField("l_orderkey", LongType()), StructField("l_linenumber", LongType()),
                   StructField("totale_casi", LongType()), StructField("data", StringType())])


def _landed(spark, sf, use):
    """``use`` of a feed written from lineitem, kept; the files go. It lies in
    two sets of CSV files, their columns in different orders, and some of its
    counts and days cannot be read (S1-S3)."""
    li = A.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    d, kind = F.to_date("l_shipdate"), (F.col("l_orderkey") + F.col("l_linenumber")) % 7
    whole = F.col("l_quantity").cast("bigint").cast("string")
    count = (F.when(kind == 0, F.concat(whole, F.lit(".0"))).when(kind == 1, F.concat(whole, F.lit("x")))
             .when(kind == 2, F.lit("NA")).when(kind == 3, F.concat(whole, F.lit(".5"))).otherwise(whole))
    day = (F.when(kind == 3, F.concat(F.year(d).cast("string"), F.lit("-02-30")))
           .when(kind == 4, F.lit("soon")).when(kind == 5, F.lit(None).cast("string"))
           .otherwise(F.date_format(d, "yyyy-MM-dd")))
    feed = li.select("l_orderkey", "l_linenumber", count.alias("totale_casi"), day.alias("data"))
    path = scratch_folder(spark, "feed")
    try:
        for name, even, columns in (("a", True, feed.columns), ("b", False, feed.columns[::-1])):
            (feed.filter((F.col("l_orderkey") % 2 == 0) == F.lit(even)).select(*columns)
             .write.option("header", True).csv(f"{path}/{name}"))
        read = read_with_rejects(spark, [f"{path}/a", f"{path}/b"], FEED, days=["data"])
        return P.materialise(use(read))
    finally:
        drop_folder(spark, path)


def feed_rows(spark, sf):
    """Every row of a landed feed, with the texts that could not be read."""
    return _landed(spark, sf, lambda feed: feed.select(
        "l_orderkey", "l_linenumber", "totale_casi", parse_day("data").alias("day"),
        F.col(REJECTED)["totale_casi"].alias("bad_count"), F.col(REJECTED)["data"].alias("bad_day")))


def feed_rejects(spark, sf):
    """Rows and rejects of each column of a landed feed."""
    return _landed(spark, sf, lambda feed: reject_counts(feed, FEED.names))


def result_months(spark, sf):
    """The incidence series written by month and two months' days of it read back."""
    path = scratch_folder(spark, "result")
    try:
        write_result(conform_incidence(spark, sf), path, CFG.date)
        return P.materialise(read_result(spark, path, months(CFG.day(40), CFG.as_of)))
    finally:
        drop_folder(spark, path)


def published_text(spark, sf):
    """The mean quantity per order as published CSV, read back as text."""
    path = scratch_folder(spark, "published")
    try:
        publish_csv(strict_mean_q(spark, sf), path, order_by=["l_orderkey"])
        return P.materialise(spark.read.option("header", True).option("inferSchema", False).csv(path))
    finally:
        drop_folder(spark, path)


def number_text_q(spark, sf):
    """Prices, large and small numbers made from them, as published text."""
    li = A.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    x = F.col("l_extendedprice")
    cents = F.rint(x * 100).cast("bigint")
    return li.select("l_orderkey", "l_linenumber", number_text(F.rint(x)).alias("whole"),
                     number_text(cents / 4).alias("quarters"),
                     number_text(cents * F.lit(1 << 38) + 1, integral=True).alias("exact"),
                     number_text(cents.cast("double") * float(1 << 50)).alias("large"))


def join_null_keys(spark, sf):
    """J1's join where nations and days are missing on either side (F12):
    NULL entities match, rows without a day go."""
    orders = A.table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    cust = A.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    entity = F.nullif(F.col("c_nationkey"), F.lit(7))
    left = (orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.when(F.col("o_orderkey") % 11 != 0, F.to_date("o_orderdate")).alias("day"),
                    entity.alias("entity")).filter("day is not null")
            .groupBy("day", "entity").agg(F.count(F.lit(1)).alias("n_orders")))
    right = cust.groupBy(entity.alias("entity")).agg(F.count(F.lit(1)).alias("n_customers"))
    return natural_join(left, right.filter(~F.col("entity").eqNullSafe(3)), "left")


def snapshot_labelled(spark, sf):
    return R.snapshot_labelled(full_result(spark, sf), CFG)


def snapshot_map(spark, sf):
    return R.snapshot_map(full_result(spark, sf), CFG)


def snapshot_scatter(spark, sf):
    return R.snapshot_scatter(full_result(spark, sf), CFG)


def arrow(spark, sf):
    return R.arrow(full_result(spark, sf), CFG)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "conform_incidence": conform_incidence,
    "entity_recode": entity_recode,
    "dose_sums": dose_sums,
    "completed_courses": completed_courses,
    "incidence_with_total": incidence_with_total,
    "vaccination_with_total": vaccination_with_total,
    "dimension_with_total": dimension_with_total,
    "lag_increment": lag_increment,
    "running_total": running_total_q,
    "lag_increment_by_month": lag_increment_by_month,
    "running_total_by_month": running_total_by_month_q,
    "strict_sum": strict_sum_q,
    "strict_mean": strict_mean_q,
    "strict_cumsum": strict_cumsum_q,
    "join_dimension": join_dimension,
    "join_right": join_right,
    "round_parity": round_parity,
    "week_number_label": week_number_label,
    "date_filters": date_filters,
    "drop_incomplete": drop_incomplete_q,
    "drop_last_key": drop_last_key_q,
    "weekly_mean_long": weekly_mean_long,
    "weekly_wide": weekly_wide,
    "daily_wide": daily_wide,
    "events_daily_wide": events_daily_wide,
    "weighted_count": weighted_count_q,
    "full_result": full_result,
    "snapshot_labelled": snapshot_labelled,
    "snapshot_map": snapshot_map,
    "snapshot_scatter": snapshot_scatter,
    "arrow": arrow,
    "feed_cells": feed_cells,
    "date_spellings": date_spellings,
    "feed_rows": feed_rows,
    "feed_rejects": feed_rejects,
    "result_months": result_months,
    "published_text": published_text,
    "number_text": number_text_q,
    "join_null_keys": join_null_keys,
}
