"""The driver's TPC-H-style tables as the pipeline's three inputs.

Entity = nation name. Mapping (one configuration of the generic pipeline):

incidence (entity x day): lineitem -> orders -> customer -> nation, by
  (ship day, customer nation); ``totale_casi`` = running sum of the day's
  quantity, ``terapia_intensiva`` = lines of ``1-URGENT`` orders,
  ``ricoverati_con_sintomi`` = lines of ``F`` orders. ``data`` is written as
  date-time text ``yyyy-MM-ddT18:00:00`` like the source feed.
vaccination (raw line grain): lineitem -> supplier -> nation; age band =
  line number, supplier = return flag (``R`` is the single-dose one),
  first dose = quantity of ``F`` lines, second dose = quantity of ``O``
  lines, prior infection = 1 for lines without discount.
dimension (entity): customer -> nation; population = 5000 x customers,
  beds = 3 x customers, ICU beds = 1 + customers with negative balance.
population (entity x customer): weight = customer key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import PipelineConfig

DRIVER = PipelineConfig(
    total_label="TOTAL",
    single_dose_supplier="R",
    recode=(),
    weekly_start=dt.date(1997, 7, 5),
    as_of=dt.date(1998, 6, 3),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nation table; its size in bytes decides whether it is broadcast."""
    return table(spark, sf_dir, "nation").select("n_nationkey", "n_name")


def incidence_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (ship day, customer nation): quantity and the two line counts."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_quantity")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = _nations(spark, sf_dir)
    # joins of base tables, whose sizes are known from the files
    lines = (li.join(orders, li.l_orderkey == orders.o_orderkey)
             .join(cust, F.col("o_custkey") == F.col("c_custkey"))
             .join(nation, F.col("c_nationkey") == F.col("n_nationkey")))
    return (lines.groupBy(F.to_date("l_shipdate").alias("d"), F.col("n_name").alias("region"))
            .agg(F.sum("l_quantity").alias("qty"),
                 F.count(F.when(F.col("o_orderpriority") == "1-URGENT", 1)).alias("ti"),
                 F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("ric")))


def incidence_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incidence feed: cumulative cases, ICU and hospital counts."""
    daily = incidence_daily(spark, sf_dir)
    w = (Window.partitionBy("region").orderBy("d")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return daily.select(
        F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit("T18:00:00")).alias("data"),
        F.col("region").alias("denominazione_regione"),
        F.sum("qty").over(w).cast("bigint").alias("totale_casi"),
        F.col("ti").cast("bigint").alias("terapia_intensiva"),
        F.col("ric").cast("bigint").alias("ricoverati_con_sintomi"),
    )


def vaccination_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vaccination feed at its raw grain (one line = one record)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag",
        "l_linestatus", "l_shipdate")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = _nations(spark, sf_dir)
    lines = (li.join(supp, li.l_suppkey == supp.s_suppkey)
             .join(nation, F.col("s_nationkey") == F.col("n_nationkey")))
    qty = F.col("l_quantity")
    return lines.select(
        F.to_date("l_shipdate").alias("data_somministrazione"),
        F.col("n_name").alias("nome_area"),
        F.col("l_linenumber").cast("string").alias("fascia_anagrafica"),
        F.col("l_returnflag").alias("fornitore"),
        F.when(F.col("l_linestatus") == "F", qty).otherwise(F.lit(0.0)).cast("bigint").alias("prima_dose"),
        F.when(F.col("l_linestatus") == "O", qty).otherwise(F.lit(0.0)).cast("bigint").alias("seconda_dose"),
        F.when(F.col("l_discount") == 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("pregressa_infezione"),
    )


def dimension_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regional dimension: beds, ICU beds and population per nation."""
    cust = table(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal")
    nation = _nations(spark, sf_dir)
    per_key = cust.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("c_acctbal") < 0, 1)).alias("neg"))
    joined = per_key.join(nation, per_key.c_nationkey == nation.n_nationkey)
    return joined.select(
        F.col("n_name").alias("denominazione_regione"),
        (F.col("n") * 3).cast("bigint").alias("PL_area_non_critica"),
        (F.col("neg") + 1).cast("bigint").alias("PL_terapia_intensiva"),
        (F.col("n") * 5000).cast("bigint").alias("popolazione"),
    )


def population_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The (inactive) population feed: one weight per customer and nation."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = _nations(spark, sf_dir)
    return cust.join(nation, cust.c_nationkey == nation.n_nationkey).select(
        F.col("n_name").alias("denominazione_regione"),
        F.col("c_custkey").cast("bigint").alias("totale_generale"))
