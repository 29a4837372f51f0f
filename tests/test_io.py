"""Sources and sinks: CSV with declared schema, NA nulls, published text, result round trip."""

import csv
import datetime as dt
import glob
import os
import tempfile

from pressio.sources import publish_csv, read_result, read_table, schemas, write_result


def test_csv_read_with_schema_and_na(spark):
    d = tempfile.mkdtemp(prefix="pressio-io-")
    path = os.path.join(d, "inc.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("data,denominazione_regione,totale_casi,terapia_intensiva,ricoverati_con_sintomi\n")
        fh.write("2020-02-24T18:00:00,Valle d'Aosta / Vallée d'Aoste,5,NA,1\n")
        fh.write(",Lazio,,0,0\n")
    df = read_table(spark, path, schemas.INCIDENCE)
    rows = df.collect()
    assert rows[0]["denominazione_regione"] == "Valle d'Aosta / Vallée d'Aoste"
    assert rows[0]["terapia_intensiva"] is None and rows[1]["data"] is None
    assert rows[1]["totale_casi"] is None


def test_publish_csv_text(spark):
    d = tempfile.mkdtemp(prefix="pressio-io-")
    df = spark.createDataFrame([("A", 10.0, 17116550, 86.50999999999999), ("B", None, 1, 0.5)],
                               "e string, x double, n long, p double")
    out = os.path.join(d, "pub")
    publish_csv(df, out, order_by=["e"])
    files = glob.glob(os.path.join(out, "part-*.csv"))
    assert len(files) == 1
    with open(files[0], encoding="utf-8") as fh:
        rows = list(csv.reader(fh))
    assert rows == [["e", "x", "n", "p"], ["A", "10", "17116550", "86.50999999999999"],
                    ["B", "NA", "1", "0.5"]]


def test_result_round_trip_partitioned(spark):
    from pressio.sources.io import months
    d = tempfile.mkdtemp(prefix="pressio-io-")
    df = spark.createDataFrame([(dt.date(2022, 5, 17), "A", 1.5), (dt.date(2022, 4, 1), "B", 2.0),
                                (dt.date(2022, 5, 3), "C", 3.0)], "data date, e string, v double")
    write_result(df, os.path.join(d, "res"))
    parts = sorted(x for x in os.listdir(os.path.join(d, "res")) if x.startswith("month="))
    assert parts == ["month=2022-04", "month=2022-05"]
    back = read_result(spark, os.path.join(d, "res"))
    assert back.columns == ["data", "e", "v"]
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())
    may = read_result(spark, os.path.join(d, "res"), months(dt.date(2022, 5, 17), dt.date(2022, 5, 17)))
    plan = may._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2022-05" in plan
    assert sorted(r["e"] for r in may.collect()) == ["A", "C"]
    assert months(dt.date(2021, 11, 5), dt.date(2022, 2, 1)) == ["2021-11", "2021-12", "2022-01",
                                                                  "2022-02"]


def test_vaccination_csv_bad_date_becomes_null_and_is_dropped(spark):
    from pressio import REFERENCE
    from pressio.plans.result import conform_vaccinations
    d = tempfile.mkdtemp(prefix="pressio-io-")
    path = os.path.join(d, "vax.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("data_somministrazione,nome_area,fascia_anagrafica,fornitore,prima_dose,"
                 "seconda_dose,pregressa_infezione\n")
        fh.write("2021-02-30,Lazio,12-19,Pfizer,1,2,0\n")
        fh.write("2021-03-01,Provincia Autonoma Trento,12-19,Janssen,x,2,0\n")
    raw = read_table(spark, path, schemas.VACCINATION)
    rows = conform_vaccinations(raw, REFERENCE).collect()
    assert len(rows) == 1
    assert rows[0]["denominazione_regione"] == "P.A. Trento" and rows[0]["prima_dose"] is None


def test_csv_columns_taken_by_header_name(spark):
    d = tempfile.mkdtemp(prefix="pressio-io-")
    path = os.path.join(d, "feed.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("data,stato,codice_regione,denominazione_regione,lat,ricoverati_con_sintomi,"
                 "terapia_intensiva,totale_casi,note\n")
        fh.write("2020-02-24T18:00:00,ITA,13,Abruzzo,42.35,3,1,10,\n")
    row = read_table(spark, path, schemas.INCIDENCE).first()
    assert tuple(row) == ("2020-02-24T18:00:00", "Abruzzo", 10, 1, 3)


def test_month_larger_than_the_others_is_split(spark):
    """One hot month: several files, each in day order, nothing lost."""
    from pyspark.sql import functions as F
    d = os.path.join(tempfile.mkdtemp(prefix="pressio-io-"), "res")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    df = (spark.range(200_000).select(
        F.when(F.col("id") < 199_000, F.date_add(F.lit(dt.date(2022, 5, 1)), (F.col("id") % 31).cast("int")))
        .otherwise(F.lit(dt.date(2022, 4, 3))).alias("data"),
        F.sha2(F.col("id").cast("string"), 256).alias("e"), F.col("id").alias("v")))
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        write_result(df, d)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = glob.glob(os.path.join(d, "month=2022-05", "*.parquet"))
    assert len(files) > 2 and len(glob.glob(os.path.join(d, "month=2022-04", "*.parquet"))) >= 1
    import pyarrow.parquet as pq
    for f in files:
        days = pq.read_table(f, columns=["data"]).column("data").to_pylist()
        assert days == sorted(days)
    back = read_result(spark, d)
    assert back.agg(F.sum("v"), F.count("e")).first() == (199_999 * 100_000, 200_000)


def test_published_order_over_several_files(spark):
    from pyspark.sql import functions as F
    d = os.path.join(tempfile.mkdtemp(prefix="pressio-io-"), "pub")
    df = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("e"), F.col("id").alias("n"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",
                                          "spark.sql.adaptive.coalescePartitions.minPartitionSize")}
    try:
        for k in old:
            spark.conf.set(k, "64k")
        publish_csv(df, d, order_by=["e"])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    rows = []
    files = sorted(glob.glob(os.path.join(d, "part-*.csv")))
    for f in files:
        with open(f, encoding="utf-8") as fh:
            rows += list(csv.reader(fh))[1:]
    assert len(files) > 1 and len(rows) == 20_000 and rows == sorted(rows)


def _feed(d, name, text):
    with open(os.path.join(d, name), "w", encoding="utf-8") as fh:
        fh.write(text)


def test_numbers_as_feeds_spell_them(spark):
    d = tempfile.mkdtemp(prefix="pressio-io-")
    _feed(d, "a.csv", "denominazione_regione,totale_generale\nA,1234.0\nB,1e5\nC, 7 \nD,x\nE,NA\nF,\"\"\n"
          "G,9007199254740993\n\"\",3\nI,-2.0\nJ,NaN\nK,1e30\n")
    got = [tuple(r) for r in read_table(spark, os.path.join(d, "a.csv"), schemas.POPULATION).collect()]
    assert got == [("A", 1234), ("B", 100000), ("C", 7), ("D", None), ("E", None), ("F", None),
                   ("G", 9007199254740993), (None, 3), ("I", -2), ("J", None), ("K", None)]


def test_fraction_in_an_integer_column_is_refused(spark):
    import pytest
    d = tempfile.mkdtemp(prefix="pressio-io-")
    _feed(d, "a.csv", "denominazione_regione,totale_generale\nA,2.5\n")
    with pytest.raises(Exception, match="not a whole number"):
        read_table(spark, os.path.join(d, "a.csv"), schemas.POPULATION).collect()


def test_files_of_a_feed_with_columns_in_their_own_order(spark):
    import pytest
    d = os.path.join(tempfile.mkdtemp(prefix="pressio-io-"), "feed.csv")
    os.mkdir(d)
    _feed(d, "a.csv", "denominazione_regione,totale_generale\nA,1\n")
    _feed(d, "b.csv", "totale_generale,extra,denominazione_regione\n2,x,B\n")
    _feed(d, "c.csv", "denominazione_regione,totale_generale\nC,3\n")
    got = sorted(tuple(r) for r in read_table(spark, d, schemas.POPULATION).collect())
    assert got == [("A", 1), ("B", 2), ("C", 3)]
    _feed(d, "d.csv", "denominazione_regione\nD\n")
    with pytest.raises(ValueError, match="missing columns"):
        read_table(spark, d, schemas.POPULATION)


def test_published_numbers_are_one_expression(spark):
    """Many columns of numbers do not make the generated code grow: each is
    formatted by the same expression over the row's array."""
    from pressio.sources.io import publish_frame
    df = spark.range(3).selectExpr("id", *[f"id * {k} / 3.0D as `c {k}`" for k in range(40)], "'x' as texts")
    out = publish_frame(df)
    assert out.columns == df.columns
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("decimal(38,15)") <= 2
    row = out.orderBy("id").collect()[1]
    assert row["id"] == "1" and row["c 3"] == "1" and row["c 1"] == "0.3333333333333333" and row["texts"] == "x"


def test_headers_of_many_files_are_found_in_one_pass(spark, tmp_path, monkeypatch):
    """Files are grouped by their first line that is not blank; one file of each is looked at."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from pressio.sources import io

    for i in range(12):
        text = "a,b\n1,x\n" if i % 3 else "\n  \nb,a\nx,2\nb,a\n"
        (tmp_path / f"{i}.csv").write_text(text)
    looked, one = [], io._csv
    monkeypatch.setattr(io, "_csv", lambda s, p: looked.append(p) or one(s, p))
    kinds = StructType([StructField("a", LongType()), StructField("b", StringType())])
    got = io.read_with_rejects(spark, str(tmp_path), kinds).select("a", "b", F.col("rejected")["a"].alias("bad"))
    assert sorted(map(str, got.collect())) == sorted(
        ["Row(a=1, b='x', bad=None)"] * 8 + ["Row(a=2, b='x', bad=None)", "Row(a=None, b='b', bad='a')"] * 4)
    assert len(looked) == 3           # the folder, and a file of each header
