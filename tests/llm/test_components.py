import random

from pressio.llm import _common, components
from pressio.llm._common import setting
from pressio.llm.buckets import bucket_components
from pressio.llm.components import connected_components


def test_paths_cycles_and_stars(spark):
    rnd = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    links += [(200, 201), (201, 202), (202, 200), (300, 300), (None, 5), (7, None), (200, 201)]
    rnd.shuffle(links)
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(links, "src long, dst long")).collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200, 202: 200}
    assert got == want


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long")).collect() == []


def test_buckets_lose_no_link(spark):
    """One bucket: a hub linked to nothing, and groups that only link among themselves."""
    members = spark.createDataFrame([(1, i, 10) for i in range(60)], "key long, rep long, n long")
    group = {i: i % 7 for i in range(1, 60)}

    def verify(pairs):
        rows = [(r.a, r.b, None, bool(r.a and r.b and group[r.a] == group[r.b])) for r in pairs.collect()]
        return spark.createDataFrame(rows, "a long, b long, far double, linked boolean")

    got = {r.node: r.component for r in bucket_components(members, lambda _: verify, 80).collect()}
    assert got == {i: g or 7 for i, g in group.items()}


def test_distances_to_the_hub_spare_comparisons(spark):
    """Points on a line: far ones are never compared, chains are found."""
    at = {i: 0.07 * (i % 40) + 0.001 * (i // 40) for i in range(120)}
    members = spark.createDataFrame([(1, i, 10) for i in at], "key long, rep long, n long")
    seen = []

    def verify(pairs):
        rows = [(r.a, r.b, abs(at[r.a] - at[r.b]), abs(at[r.a] - at[r.b]) <= 0.15) for r in pairs.collect()]
        seen.extend(rows)
        return spark.createDataFrame(rows, "a long, b long, far double, linked boolean")

    got = {r.node: r.component for r in bucket_components(members, lambda _: verify, 85).collect()}
    assert got == {i: 0 for i in at}
    ends = [x for a, b, *_ in seen for x in (a, b)]
    hub = max(set(ends), key=ends.count)
    assert all(abs(abs(at[a] - at[hub]) - abs(at[b] - at[hub])) <= 0.15 + 1e-6
               for a, b, *_ in seen if hub not in (a, b))
    assert len(seen) == len({s[:2] for s in seen})


def test_rounds_over_few_links_shuffle_nothing(spark, monkeypatch):
    """Only the links as given are dealt out; a round over few of them is one task."""
    made, plain = [], components.cut
    monkeypatch.setattr(components, "cut", lambda df: made.append(
        df._jdf.queryExecution().executedPlan().toString()) or plain(df))
    rows = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)]
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        links = spark.createDataFrame(rows, "src long, dst long").repartition(5)
        found = {r.node: r.component for r in components.connected_components(links).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}
    assert len(made) > 2 and "Exchange" in made[0] and not any("Exchange" in plan for plan in made[1:])


def test_many_links_are_dealt_out(spark, monkeypatch):
    """Links beyond a packed partition: the same components."""
    monkeypatch.setattr(_common, "PACK", 7)
    rows = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)]
    found = components.connected_components(spark.createDataFrame(rows, "src long, dst long").repartition(5))
    assert {r.node: r.component for r in found.collect()} == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}
