"""The reader with a ledger of what it could not read."""

import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from pressio.sources import observe_rejects, read_with_rejects, reject_counts

SCHEMA = StructType([StructField("day", StringType()), StructField("n", LongType()), StructField("who", StringType())])


def landed():
    d = tempfile.mkdtemp(prefix="pressio-rejects-")
    with open(os.path.join(d, "a.csv"), "w", encoding="utf-8") as fh:
        fh.write('day,n,who\n2020-01-01,5,x\n2020-02-30,5.0,x\n2020-01-02,5.5,"a,b"\n,NA,\n2020-01-03,1,x,extra\nsoon,1e2,y\n2020-01-04,2\n')
    with open(os.path.join(d, "b.csv"), "w", encoding="utf-8") as fh:
        fh.write("more,who,n,day\nm,z,many,2020-01-05\n")
    return d


def test_rows_and_ledger(spark):
    rows = {tuple(r)[:3] + (tuple(sorted(r["rejected"].items())),)
            for r in read_with_rejects(spark, landed(), SCHEMA, ["day"]).collect()}
    assert rows == {
        ("2020-01-01", 5, "x", ()),
        ("2020-02-30", 5, "x", (("day", "2020-02-30"),)),
        ("2020-01-02", None, "a,b", (("n", "5.5"),)),
        (None, None, None, ()),
        (None, None, None, (("(record)", "2020-01-03,1,x,extra"),)),
        ("soon", 100, "y", (("day", "soon"),)),
        (None, None, None, (("(record)", "2020-01-04,2"),)),
        ("2020-01-05", None, "z", (("n", "many"),)),
    }


def test_counts_exact_and_observed(spark):
    read = read_with_rejects(spark, landed(), SCHEMA, ["day"])
    want = {"day": 2, "n": 2, "who": 0, "(record)": 2}
    assert {r["column"]: r["n_rejected"] for r in reject_counts(read, SCHEMA.names).collect()} == want
    assert {r["n_rows"] for r in reject_counts(read, SCHEMA.names).collect()} == {8}
    df, seen = observe_rejects(read, SCHEMA.names)
    assert df.columns == SCHEMA.names
    assert len(df.select("who").collect()) == 8
    assert seen.get == want


def test_parquet_and_empty(spark):
    d = tempfile.mkdtemp(prefix="pressio-rejects-")
    (spark.createDataFrame([("2020-01-01", "7", "x"), ("?", "7.5", None)], "day string, n string, who string")
     .withColumn("other", F.lit(1)).write.parquet(os.path.join(d, "p")))
    read = read_with_rejects(spark, os.path.join(d, "p"), SCHEMA, ["day"], fmt="parquet")
    assert {(r["n"], tuple(sorted(r["rejected"].items()))) for r in read.collect()} == {
        (7, ()), (None, (("day", "?"), ("n", "7.5")))}
    none = read.filter("who = 'nobody'")
    assert none.collect() == [] and reject_counts(none, SCHEMA.names).collect() == []
