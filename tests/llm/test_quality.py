import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressio.llm import quality, queries


@pytest.fixture
def corpus(words):
    rnd = random.Random(5)
    rows = []
    for i in range(240):
        w = words(rnd.randint(20, 120))
        bad = i % 5 == 0
        text = "!! ".join(x.upper() for x in w) if bad else " ".join(w).capitalize() + "."
        rows.append((i, text, rnd.choice(["en", "de"]), rnd.choice(["a", "b", None])))
    return rows


def test_good_and_bad_are_told_apart(spark, docs, corpus):
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(0, 240, 2)]
                                   + [(None, 1), (3, None), (1, 7), (2, 1)], "doc_id long, quality int")
    more = [(900, None, "en", "a"), (901, "", None, None), (902, " \n", "en", "a"),
            (903, " ".join(["word"] * 50_000), "en", "c"), (None, corpus[1][1], "en", "a"), corpus[7]]
    got = quality.judge(docs(corpus + more), labels).collect()
    assert len(got) == len(corpus) + len(more)
    for r in got:
        assert 0 <= r.p_quality <= 1 and r.kept == (r.p_quality >= 0.5)
        if r.doc_id is not None and r.doc_id < 240:
            assert r.kept == (r.doc_id % 5 != 0)
        if r.doc_id in (900, 901, 902):
            assert not r.kept and r.p_doc == 0


def test_sparse_sites_are_shrunk(spark, docs):
    """Equal texts, labels that differ by host: the rates of hosts with few
    documents lie nearer the global one."""
    rows = [(i, "same words here", "en", "big") for i in range(200)]
    rows += [(1000 + i, "same words here", "en", "bad") for i in range(200)]
    rows += [(2000, "same words here", "en", "tiny")]
    labels = spark.createDataFrame(
        [(i, int(i % 10 != 0)) for i in range(200)] + [(1000 + i, int(i % 10 == 0)) for i in range(200)]
        + [(2000, 0)], "doc_id long, quality int")
    r = {x.source: x for x in quality.judge(docs(rows), labels).collect()}
    assert r["bad"].host_rate < r["tiny"].host_rate < r["big"].host_rate
    assert abs(r["tiny"].host_rate - 0.5) < abs(r["bad"].host_rate - 0.5)
    assert r["big"].kept and not r["bad"].kept


def test_without_labels_all_with_words_stay(spark, docs, corpus):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.good_documents(docs(corpus + [(900, "")]), none).collect()
    assert sorted(r.doc_id for r in got) == list(range(240))
    assert quality.judge(docs([]), none).collect() == []


def test_held_out_accuracy(spark, tables):
    """Fitted on half of the labels, judged by the other half."""
    docs = spark.read.parquet(f"{tables}/documents.parquet").drop("n_chars")
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    half = F.pmod(F.xxhash64(F.lit(99), "doc_id"), F.lit(2)) == 0
    rows = quality.judge(docs, labels.filter(half)).join(
        labels.filter(~half).withColumnRenamed("quality", "truth").select("doc_id", "truth"), "doc_id").collect()
    good = [r.kept for r in rows if r.truth == 1]
    bad = [not r.kept for r in rows if r.truth == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) >= 0.9


def test_whole_table_and_reruns(spark, tables):
    a = {r.doc_id: r for r in queries.op4_quality(spark, tables).collect()}
    b = {r.doc_id: r for r in queries.op4_quality(spark, tables).collect()}
    assert len(a) == spark.read.parquet(f"{tables}/documents.parquet").count()
    assert all(a[i].kept == b[i].kept and abs(a[i].p_quality - b[i].p_quality) < 1e-9 for i in a)
