"""Plan checks: no Python in any plan, pruning and pushdown reach the scan,
no single-partition exchange in the pipeline, adaptive execution on."""

import pytest

import __spark_entry__ as E
from given import SF001
from pressio.plans import catalog


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# The greatest (week, year) is a one-row global aggregate (a scalar subquery).
GLOBAL_ONE_ROW = {"drop_last_key", "weekly_wide"}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_and_no_single_partition(spark, name):
    p = plan(E.queries()[name](spark, SF001))
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p
    assert "PythonUDF" not in p
    if name not in GLOBAL_ONE_ROW:
        assert "SinglePartition" not in p
    if "Exchange" in p:  # a product over the materialised result may need none
        assert "AdaptiveSparkPlan" in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(E.queries()["dose_sums"](spark, SF001))
    scans = [line for line in p.splitlines() if "FileScan parquet" in line and "lineitem" in line]
    assert scans
    for line in scans:
        schema = line.split("ReadSchema: ")[1]
        assert "l_extendedprice" not in schema and "l_tax" not in schema


LAZY = ["snapshot_labelled", "snapshot_map", "snapshot_scatter", "arrow"]


@pytest.mark.parametrize("name", LAZY)
def test_products_run_no_job_while_they_are_built(spark, name):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"build-{name}", "")
    try:
        p = plan(E.queries()[name](spark, SF001))
        jobs = tracker.getJobIdsForGroup(f"build-{name}")
        # reading a table's schema is a job of its own; the query's exchanges are not run
        assert "ExistingRDD" not in p
        stages = [tracker.getStageInfo(s) for j in jobs for s in tracker.getJobInfo(j).stageIds]
        assert all(s is None or s.numTasks <= 1 for s in stages)
    finally:
        spark.sparkContext.setJobGroup("", "")


@pytest.mark.parametrize("name", LAZY)
def test_product_day_filter_reaches_the_scan(spark, name):
    """The vaccination side reads only its columns of the wanted days' rows
    where the running total allows it; unused incidence columns are pruned."""
    p = plan(E.queries()[name](spark, SF001))
    day = str(catalog.CFG.day(catalog.CFG.snapshot_lag))
    assert "l_tax" not in p and "l_comment" not in p
    assert any(day in line for line in p.splitlines() if "Filter" in line)


def test_map_reads_fewer_columns_than_the_full_result(spark):
    def columns(name):
        p = plan(E.queries()[name](spark, SF001))
        return sum(line.split("ReadSchema: ")[1].count(":") for line in p.splitlines() if "ReadSchema: " in line)
    assert columns("snapshot_map") < columns("full_result")


def test_full_result_has_few_exchanges(spark):
    p = plan(E.queries()["full_result"](spark, SF001))
    assert p.count("Exchange hashpartitioning") <= 10


def test_pushed_day_filter_of_the_date_query(spark):
    p = plan(E.queries()["conform_incidence"](spark, SF001))
    assert "PushedFilters: [IsNotNull(l_orderkey)" in p


def test_totals_are_single_pass(spark):
    """A1 reads its input once: one scan of each joined table."""
    p = plan(E.queries()["incidence_with_total"](spark, SF001))
    assert p.count("FileScan parquet") == 4  # lineitem, orders, customer, nation
    assert "Expand" in p
