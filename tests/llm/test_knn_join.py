import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pressio.llm import knn_join, oracles, queries

KIND = "vec_id long, embedding array<double>"


def brute(rows, k, every):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and len(v) == 6
            and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in good:
        if i % every == 0:
            s = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i)
            out += [(i, n, j, -x) for n, (x, j) in enumerate(s[:k], 1)]
    return sorted(out)


def run(df, k=5, every=3, **kw):
    v = knn_join.quantised(df, "vec_id", "embedding")
    rows = knn_join.top_k(v.filter(F.col("id") % every == 0), v, k, **kw).collect()
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in rows)


@pytest.fixture
def rows():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(10, 6))
    out = [(i, (centres[i % 10] * (1 + i % 4) + rng.normal(size=6) * 0.05).tolist()) for i in range(300)]
    out += [(300 + i, [0.5] * 6) for i in range(20)]              # ties
    odd = [None, [], [1.0] * 3, [float("nan")] * 6, [float("-inf")] + [1.0] * 5, [None] * 6, [0.0] * 6]
    return out + [(400 + i, v) for i, v in enumerate(odd)] + [(None, [1.0] * 6)]


@pytest.mark.parametrize("pivots", [1, 7, 64])
def test_equal_to_brute_force(spark, rows, monkeypatch, pivots):
    monkeypatch.setattr(knn_join, "QUERY_BLOCK", 16)
    monkeypatch.setattr(knn_join, "DATA_BLOCK", 32)
    df = spark.createDataFrame(rows, KIND).repartition(4)
    for name in ("id", "v", "g", "rank", "score", "m"):
        df = df.withColumn(name, F.lit(1))
    assert run(df, pivots=pivots) == brute(rows, 5, 3)


def test_fewer_candidates_than_k(spark):
    rows = [(0, [1.0] * 6), (3, [2.0] * 6), (4, [0.5] * 6)]
    assert run(spark.createDataFrame(rows, KIND)) == brute(rows, 5, 3)
    assert run(spark.createDataFrame([(0, [1.0] * 6)], KIND)) == []


def test_empty_tables(spark):
    assert run(spark.createDataFrame([], KIND)) == []
    assert run(spark.createDataFrame([(1, [1.0])], KIND)) == []


def test_scores_beyond_exact_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        run(spark.createDataFrame([(0, [1e9] * 6), (1, [1e9] * 6)], KIND))


def test_query_equals_sql(spark, tables):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tables}/embeddings.parquet')")
    rel = con.execute(oracles.OP10)
    cols = [d[0] for d in rel.description]
    want = sorted(tuple(dict(zip(cols, r))[c] for c in ("query_id", "rank", "vec_id", "score"))
                  for r in rel.fetchall())
    got = queries.op10_knn_join(spark, tables).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == want


def test_large_vectors_are_scored_with_integers(spark, rows):
    """Scores past 2^53, of queries and of data, beside all the others."""
    big = [(500, [1e6 + 0.5, -3.0, 2.0, 1.0, 0.25, 7.0]), (501, [3e6, 1.0, 0.0, 0.0, 0.0, -2.5]),
           (502, [-2e5, 9e5, 1.0, 2.0, 3.0, 4.0]), (503, [3e6 + 1 / 256, 1.0, 0.0, 0.0, 0.0, -2.5])]
    df = spark.createDataFrame(rows + big, KIND).repartition(4)
    want = brute(rows + big, 5, 3)
    assert max(s for *_, s in want) > 1 << 53
    assert run(df) == want


def test_only_large_vectors(spark):
    rows = [(i, [1e5 * (i + 1)] * 6) for i in range(8)]
    assert run(spark.createDataFrame(rows, KIND)) == brute(rows, 5, 3)
