import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pressio.llm import embedding_dedup, oracles, queries

KIND = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.93):
    good = []
    for i, v, y in rows:
        if i is None or y is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = np.array(v, np.float64)
        if len(x) == 8 and np.abs(x).max() > 0:
            good.append((i, x / np.sqrt((x * x).sum()), y))
    n, root = {}, {r[0]: r[0] for r in rows if r[0] is not None}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for k, (i, x, y) in enumerate(good):
        for j, z, t in good[k + 1:]:
            if y == t and x @ z >= threshold:
                n[i], n[j] = n.get(i, 0) + 1, n.get(j, 0) + 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (n.get(i, 0), find(i)) for i in root}


@pytest.fixture
def rows():
    rng = np.random.default_rng(4)
    out, i = [], 0
    for label in (0, 1, 2):
        for _ in range(30):
            c = rng.normal(size=8)
            for _ in range(rng.integers(1, 8)):
                out.append((i, (c + rng.normal(size=8) * rng.choice([0, 0.05, 0.15, 0.3])).tolist(), label))
                i += 1
    v = out[0][1]
    odd = [None, [], [0.0] * 8, [float("nan")] * 8, [float("inf")] + [1.0] * 7, [None] + [1.0] * 7, [1.0] * 3]
    out += [(1000 + k, x, 0) for k, x in enumerate(odd)]
    out += [(2000, v, None), (2001, v, 0), (2002, v, 1), (2003, [x * 1000 for x in v], 0)]
    return out


def check(got, want):
    assert {r.vec_id for r in got} == set(want)
    for r in got:
        assert (r.n_links, r.component_id) == want[r.vec_id]
        assert r.kept == (r.vec_id == r.component_id)


def test_links_equal_brute_force(spark, rows):
    df = spark.createDataFrame(rows, KIND)
    for name in ("id", "v", "m", "n", "cell", "own", "trip", "h1"):
        df = df.withColumn(name, F.lit(1))
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]     # as floats
    check(embedding_dedup.near_duplicates(df.repartition(3), per_cell=4, recall=1.0).collect(), brute(rows))


def test_hot_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 64)
    rng = np.random.default_rng(1)
    c = rng.normal(size=8)
    rows = [(i, (c + rng.normal(size=8) * 0.02).tolist() if i % 3 else c.tolist(), 1) for i in range(300)]
    rows += [(1000 + i, rng.normal(size=8).tolist(), 1) for i in range(200)]
    df = spark.createDataFrame(rows, KIND)
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    check(embedding_dedup.near_duplicates(df, per_cell=8).collect(), brute(rows))


def test_rows_that_share_an_id_and_null_ids(spark):
    v, w = [1.0] * 8, [1.0, -1.0] * 4
    rows = [(1, v, 0), (1, v, 0), (1, w, 0), (2, w, 0), (None, v, 0)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, KIND)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got if r.vec_id) == [
        (1, 1, 1), (1, 1, 1), (1, 1, 1), (2, 1, 1)]
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)]


def test_empty_and_unusable_tables(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], KIND)).collect() == []
    got = embedding_dedup.near_duplicates(spark.createDataFrame([(1, None, 0), (2, [0.0], 1)], KIND)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 0, 1), (2, 0, 2)]


def test_recall_against_brute_force(spark, tables):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tables}/embeddings.parquet')")
    rel = con.execute(oracles.OP5)
    cols = [d[0] for d in rel.description]
    want = {dict(zip(cols, r))["vec_id"]: dict(zip(cols, r)) for r in rel.fetchall()}
    got = {r.vec_id: r for r in queries.op5_embedding_dedup(spark, tables).collect()}
    assert set(got) == set(want)
    true = sum(r["n_links"] for r in want.values())
    assert sum(r.n_links for r in got.values()) >= 0.99 * true
    assert all(got[i].n_links <= want[i]["n_links"] for i in want)


def test_traversal_is_in_order_of_distance():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = embedding_dedup.MultiIndex(x, 6, -1.0)
    index.reach = np.inf
    a, b = (embedding_dedup._distances(h, c) for h, c in zip(embedding_dedup._halves(x), index.books))
    total = (a[:, :, None] + b[:, None, :]).reshape(len(x), -1)
    got = np.take_along_axis(total, index.traversals(x, 10), axis=1)
    assert np.allclose(got, np.sort(total, axis=1)[:, :10])
    assert (index.traversals(x, 1)[:, 0] == index.cells(x)).all()


def partner(rng, x, cosine):
    away = rng.normal(size=len(x))
    away -= away @ x * x
    return cosine * x + math.sqrt(1 - cosine * cosine) * away / np.linalg.norm(away)


def recall_of_pairs(spark, hot):
    """Share of 100 pairs just over the threshold that are found among 3000
    vectors without links and a group of ``hot`` near copies."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000 + hot, 64))
    x[3000:] = rng.normal(size=64) + rng.normal(size=(hot, 64)) * 0.01
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(10_000 + i, partner(rng, x[i], 0.9305).tolist(), 1) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.component_id for r in embedding_dedup.near_duplicates(df, per_cell=4).collect()}
    return sum(got[10_000 + i] == i for i in range(100)) / 100


def test_recall_of_rare_links(spark):
    assert recall_of_pairs(spark, 0) >= 0.97


def test_recall_of_pairs_beside_a_hot_group(spark):
    assert recall_of_pairs(spark, 1500) >= 0.97
