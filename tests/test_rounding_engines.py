"""R rounding agrees across its Spark Column form, its SQL-text form, the
DuckDB oracle form and a plain-Python statement of the rule."""

import math
import random

import duckdb
from pyspark.sql import functions as F

from pressio.functions import round_r
from pressio.plans import oracle


def rule(x, d):
    """Nearer of the two d-decimal neighbours as doubles; tie -> even digit."""
    if x is None:
        return None
    p = float(10 ** d)
    s = x * p
    if not abs(s) < 2.0 ** 52:
        return x
    lo_i, hi_i = math.floor(s), math.ceil(s)
    down, up = x - lo_i / p, hi_i / p - x
    pick = 1 if (down > up or (down == up and lo_i % 2 != 0)) else 0
    return (lo_i + (hi_i - lo_i) * pick) / p


def values():
    rnd = random.Random(7)
    out = [None, 0.0, 2.5, -2.5, 0.125, 282.605, 29669.865, -2.595, 1e17, -1e-9]
    for _ in range(3000):
        k = rnd.randint(-10 ** 7, 10 ** 7)
        scale = rnd.choice([1, 2, 3, 4, 5])
        out.append(k / 10 ** scale + rnd.choice([0.0, 0.0, 5e-4, -5e-4, 5e-3]))
    return out


def test_round_r_forms_agree(spark):
    xs = values()
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    cols = []
    for d in (0, 2, 4):
        cols += [round_r("x", d).alias(f"s{d}"), round_r(F.col("x"), d).alias(f"c{d}")]
    rows = df.select("x", *cols).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(xs)))
    sql = "SELECT i, " + ", ".join(f"{oracle.round_r('x', d)} AS d{d}" for d in (0, 2, 4)) + \
        " FROM t ORDER BY i"
    duck = con.execute(sql).fetchall()
    got = {}
    for r in rows:
        got.setdefault(r["x"], []).append(r)
    for i, x in enumerate(xs):
        for d in (0, 2, 4):
            want = rule(x, d)
            r = got[x][0]
            assert r[f"s{d}"] == want, (x, d)
            assert r[f"c{d}"] == want, (x, d)
            assert duck[i][1 + (0, 2, 4).index(d)] == want, (x, d)
