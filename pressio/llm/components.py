"""Connected components of a link table, by alternating star contractions.

Every round is a few joins and aggregations on the node id and ends in a
checkpoint in the shared folder; few links (``PACK`` in :mod:`_common`) are one
partition, whose rounds shuffle nothing. Only a count and a checksum of the links
reach the driver. The number of rounds grows with the logarithm of the
longest path (the large-star and small-star operations of Kiveris et al.,
"Connected Components in MapReduce and Beyond").
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import cut, packed, parts, shuffles_go


def _state(e: DataFrame) -> tuple:
    with shuffles_go(e.sparkSession):
        # read by as many tasks as run at once
        r = e.coalesce(max(1, e.sparkSession.sparkContext.defaultParallelism)).agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def _with_least(rows: DataFrame, few: bool) -> DataFrame:
    """``rows`` (a, b) with m, the smallest b of their a. Many are joined: of a
    large star a join can be split, a window cannot."""
    if few:
        return rows.withColumn("m", F.min("b").over(Window.partitionBy("a")))
    return rows.join(rows.groupBy("a").agg(F.min("b").alias("m")), "a")


def _round(e: DataFrame, links: int) -> DataFrame:
    """The links (a, b), a > b, after a large and a small star."""
    few, e = parts(links) == 1, packed(e, links)
    # each link from either end, read once
    both = e.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
                    .alias("e")).select("e.a", "e.b")
    large = (_with_least(both, few).filter("b > a")
             .select(F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct())
    # where b is m the link to m itself is left
    return cut(_with_least(large, few).select(
        F.when(F.col("b") != F.col("m"), F.col("b")).otherwise(F.col("a")).alias("a"), F.col("m").alias("b")).distinct())


def connected_components(links: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) of every node that has a link; component is the
    smallest node reachable (nodes are of any type that has an order). NULL ends and self links are ignored, repeated
    links count once, an empty table gives no rows."""
    a, b = F.col(src), F.col(dst)
    e = cut(links.filter(a.isNotNull() & b.isNotNull() & (a != b))
            .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    state = _state(e)
    while state[0]:
        e, before = _round(e, state[0]), state
        state = _state(e)
        if state == before:
            break
    e = packed(e, state[0])
    roots = e.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
