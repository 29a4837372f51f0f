import os
import random

import pytest

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

# Columns named like those the operators make themselves.
CLASH = {"id": 1, "n": 2, "size": 3, "rank": 4, "key": 5, "rep": 6, "place": 7, "tag": 8,
         "ids": 9, "spans": 10, "kept": 11, "component": 12, "v": 13, "_h": 14}


@pytest.fixture(scope="session")
def tables():
    if not os.path.exists(SF01):
        pytest.skip("driver tables not available")
    return SF01


@pytest.fixture
def docs(spark):
    """Makes a documents table of (doc_id, text) with clashing columns."""
    from pyspark.sql import functions as F

    def make(rows, **columns):
        kind = "doc_id long, text string, lang string, source string"
        full = [(*r, *(None,) * (4 - len(r))) for r in rows]
        df = spark.createDataFrame(full, kind).repartition(3)
        for name, value in (CLASH | columns).items():
            df = df.withColumn(name, F.lit(value))
        return df
    return make


@pytest.fixture
def words():
    rnd = random.Random(11)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(300)]

    def make(n):
        return [rnd.choice(vocabulary) for _ in range(n)]
    return make
