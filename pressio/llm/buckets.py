"""Links between members of candidate buckets, without pairing buckets off.

All members of a bucket are first compared with one hub: the member whose
buckets hold the most members over all, which in a group of near copies is the
one nearest to what most of them have in common. Members that are by then
connected to their bucket's hub need no more; each of the others (outsiders) is
compared with the members of other components, a growing number of outsiders at a
time, until all are done. A large group of alike members costs a link to a
hub each, and no pair of a bucket that could join two components is left out:
a pair is only skipped where its distances to the hub differ by more than
the largest distance of a link, which no link can (the distance is a metric),
or where its signatures rule it out, at the place where its members meet.

With ``solve`` the outsiders are not paired off: the members of a bucket lie in
blocks, of at most about ``BLOCK_ROWS`` members and ``BLOCK_SIZE`` of their sizes, outsiders and others
apart. Every two blocks with an outsider are a cell of its own, which one task
solves and of which only joining links come out, fewer than it has members.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import cut, packed
from .components import connected_components

FIRST_OUTSIDERS = 256             # few rounds: each finds components anew
GROWTH = 256
SLACK = 1e-9
BLOCK_ROWS = 512
BLOCK_SIZE = 4_000_000

Verify = Callable[[DataFrame], DataFrame]


def bucket_components(members: DataFrame, prepare: Callable[[DataFrame], Verify], percent: int,
                      sigs: DataFrame | None = None, may: Callable[[Column, Column], Column] | None = None,
                      solve: Callable[[DataFrame, DataFrame, float], DataFrame] | None = None) -> DataFrame:
    """(node, component) of every node with a link, over members (key, rep, n).

    ``n`` is a size of the node; pairs whose smaller size is under
    ``percent`` per cent of the larger cannot be linked. ``prepare`` gets the
    nodes (rep) that share a bucket and returns a function from pairs (a, b)
    to (a, b, far, linked), materialised: whether they are linked, and their
    distance, by which no link exceeds 1 - percent / 100, or NULL. With
    ``sigs`` (rep, sig), pairs are ruled out whose signatures ``may`` denies.
    ``solve`` gets the members of :func:`_cells`, the reps among them and the
    largest difference of distances to a hub that a link allows; it returns links (a, b)
    that connect what the cells' links connect.
    """
    if sigs is None:
        sigs, may = members.select("rep", F.lit(0).alias("sig")).distinct(), lambda x, y: F.lit(True)

    def alike(x, y):
        return 100 * F.least(x, y) >= percent * F.greatest(x, y)

    def possible(pairs):
        for side in ("a", "b"):
            pairs = pairs.join(sigs.select(F.col("rep").alias(side), F.col("sig").alias(f"{side}_sig")), side)
        return pairs.filter(may(F.col("a_sig"), F.col("b_sig"))).select("a", "b")

    counts = members.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    shared = cut(members.select("key", "rep", "n").join(counts, "key"))
    score = shared.groupBy("rep").agg(F.sum("c").alias("score"))
    hubs = (shared.join(score, "rep").groupBy("key").agg(F.max(F.struct("score", "rep", "n")).alias("h"))
            .select("key", F.col("h.rep").alias("hub"), F.col("h.n").alias("hub_n")))
    shared = cut(shared.drop("c").join(hubs, "key"))
    verify = prepare(shared.select("rep").distinct())
    pairs = (shared.filter((F.col("rep") != F.col("hub")) & alike(F.col("n"), F.col("hub_n")))
             .select(F.least("hub", "rep").alias("a"), F.greatest("hub", "rep").alias("b")).distinct())
    done = packed(verify(packed(cut(possible(pairs)))))
    comps = _components(done.filter("linked").select("a", "b"))
    outside = with_component(with_component(shared, "rep", "comp", comps), "hub", "hub_comp", comps)
    outside = packed(cut(outside.filter("comp <> hub_comp").select("key", "rep")))
    # outsiders of a bucket are dealt over rounds by a hash, in the measure of their number
    counts = outside.groupBy("key").agg(F.count(F.lit(1)).alias("c"))
    last = counts.agg(F.max("c")).first()[0] or 0
    if not last:
        return comps
    turn = F.floor(F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) * F.col("c") / F.lit(1 << 20))
    # the buckets that have outsiders, with each member's distance to the hub
    open_ = shared.join(counts, "key").join(outside.withColumn("out", F.lit(True)), ["key", "rep"], "left")
    open_ = open_.withColumn("a", F.least("hub", "rep")).withColumn("b", F.greatest("hub", "rep"))
    open_ = cut(open_.join(done.select("a", "b", "far"), ["a", "b"], "left").join(sigs, "rep")
                .withColumn("nth", F.when(F.col("out"), turn)).drop("a", "b", "c", "out"))
    reach = 1 - percent / 100 + SLACK
    if solve is not None:
        cells = cut(_cells(with_component(open_, "rep", "comp", comps), shared))
        found = solve(cells, cells.select("rep").distinct(), reach)
        return _components(_links(comps).unionByName(found))
    lo, step = 0, FIRST_OUTSIDERS
    while lo < last:
        now = with_component(open_, "rep", "comp", comps)
        x = now.filter((F.col("nth") >= lo) & (F.col("nth") < lo + step)).select(
            "key", F.col("rep").alias("x"), F.col("n").alias("xn"), F.col("comp").alias("xc"),
            F.col("far").alias("x_far"), F.col("sig").alias("x_sig"))
        near = F.coalesce(F.abs(F.col("x_far") - F.col("far")) <= reach, F.lit(True))
        todo = (x.join(now, "key").filter((F.col("xc") != F.col("comp")) & (F.col("rep") != F.col("hub"))
                                          & alike(F.col("xn"), F.col("n")) & near & may(F.col("x_sig"), F.col("sig")))
                .select(F.least("x", "rep").alias("a"), F.greatest("x", "rep").alias("b")).distinct()
                .join(done, ["a", "b"], "left_anti"))
        todo = packed(cut(todo))
        if todo.take(1):
            found = packed(verify(todo))
            done = done.unionByName(found)
            if found.filter("linked").take(1):
                comps = _components(_links(comps).unionByName(found.filter("linked").select("a", "b")))
        lo, step = lo + step, step * GROWTH
    return comps


def _cells(open_: DataFrame, shared: DataFrame) -> DataFrame:
    """(key, i, j, block, out, rep, n, comp, far, sig, keys): members of the cells
    i <= j of two blocks of a bucket. ``out`` marks outsiders; ``keys`` are all
    buckets of the member, so that a pair may be left to its smallest one. Hubs
    have met all members and take no part."""
    def blocks(out):
        mine = F.col("out") == out
        rows, size = F.count(F.when(mine, 1)), F.sum(F.when(mine, F.col("n")))
        return F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(F.coalesce(size, F.lit(0)) / BLOCK_SIZE))

    rows = open_.filter("rep <> hub").withColumn("out", F.col("nth").isNotNull()).drop("nth", "hub", "hub_n", "hub_comp")
    sizes = rows.groupBy("key").agg(blocks(True).alias("ob"), blocks(False).alias("ib"))
    keys = shared.groupBy("rep").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    turn = F.pmod(F.xxhash64("rep"), F.when(F.col("out"), F.col("ob")).otherwise(F.col("ib")))
    dealt = (rows.join(sizes, "key").withColumn("block", F.when(F.col("out"), turn).otherwise(F.col("ob") + turn)))
    # an outsider meets every block, the others those of outsiders
    last = F.when(F.col("out"), F.col("ob") + F.col("ib")).otherwise(F.col("ob")) - 1
    met = dealt.withColumn("t", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return (met.select("key", F.least("block", "t").alias("i"), F.greatest("block", "t").alias("j"), "block", "out",
                       "rep", "n", "comp", "far", "sig").join(keys, "rep"))


def _components(links: DataFrame) -> DataFrame:
    return packed(cut(connected_components(links, "a", "b")))


def _links(comps: DataFrame) -> DataFrame:
    """Links (a, b) that connect what is connected already: each node with its component."""
    return comps.select(F.col("node").alias("a"), F.col("component").alias("b"))


def with_component(df: DataFrame, node: str, out: str, comps: DataFrame) -> DataFrame:
    """``df`` with the component of its ``node``: itself where it has no link."""
    c = comps.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
    return (df.join(c, F.col(node) == F.col("_n"), "left")
            .withColumn(out, F.coalesce("_c", node)).drop("_n", "_c"))
