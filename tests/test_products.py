"""Product identities and join cardinality on the driver's tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from given import SF001, SF01
from pressio.plans import catalog as C
from pressio.plans import result as P
from pressio.plans import products as R

CFG = C.CFG


def _result(spark, sf):
    return P.materialise(C.full_result(spark, sf))


def test_map_and_arrow_agree_with_daily_pivot(spark):
    res = _result(spark, SF01)
    daily = {r[CFG.date]: r for r in R.daily_wide(res, CFG).collect()}
    t, t1 = CFG.day(CFG.snapshot_lag), CFG.day(CFG.previous_lag)
    for r in R.snapshot_map(res, CFG).collect():
        assert daily[t][r[CFG.entity]] == r[CFG.index]
    for r in R.arrow(res, CFG).collect():
        assert daily[t1][r[CFG.entity]] == r[f"{CFG.index}_t1"]
        if r[CFG.date] is not None:
            assert daily[t][r[CFG.entity]] == r[f"{CFG.index}_t"]


def test_right_join_keeps_vaccination_rows(spark):
    vax = C.running_total_q(spark, SF001)
    assert C.join_right(spark, SF001).count() == vax.count() == C.full_result(spark, SF001).count()


def test_running_total_differences_are_daily_values(spark):
    rt = C.running_total_q(spark, SF001)
    w = Window.partitionBy(CFG.entity).orderBy(CFG.date)
    d = rt.withColumn("diff", F.col(CFG.vaccinated) - F.lag(CFG.vaccinated).over(w))
    bad = d.filter(F.col("diff").isNotNull() & (F.col("diff") != F.col(CFG.new_vaccinated)))
    assert bad.count() == 0


def test_weekly_order_inverts_the_label(spark):
    import datetime as dt
    from pressio.functions import week_label
    pairs = [(2022, 1), (2022, 20), (2021, 27), (2021, 52), (2021, 53), (1997, 53)]
    df = spark.createDataFrame(pairs, "year int, w int").withColumn("week", week_label("year", "w"))
    got = [(r["w"], r["year"]) for r in df.orderBy(*R.weekly_order()).collect()]
    assert got == sorted((w, y) for y, w in pairs)


def test_result_independent_of_shuffle_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = sorted(map(tuple, C.full_result(spark, SF001).collect()), key=repr)
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        b = sorted(map(tuple, C.full_result(spark, SF001).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


def test_weekly_product_independent_of_shuffle_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    try:
        for n in ("2", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            wide = R.weekly_wide(_result(spark, SF01), CFG)
            out.append(sorted((tuple(r) for r in wide.collect()), key=repr))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out[0] == out[1]
