import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressio.llm import mixing, queries


def targets(sizes, share=1.5, cap=2.0):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [None] * (None in sizes)
    w = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
    capped, whole = set(), share * sum(sizes.values())
    while True:
        rest = whole - sum(cap * sizes[n] for n in capped)
        free = sum(w[n] for n in names if n not in capped)
        out = {n: cap * sizes[n] if n in capped else rest * w[n] / free for n in names}
        over = {n for n in names if n not in capped and out[n] > cap * sizes[n]}
        if not over:
            return out
        capped |= over


@pytest.fixture
def rows(words):
    rnd = random.Random(8)
    out = []
    for i in range(300):
        source = rnd.choice(["a", "a", "a", "b", "é", "Z", None])
        out.append((i, " ".join(words(rnd.randint(1, 300))), "en", source))
    out += [(300, None, "en", "a"), (301, "", "en", "empty"), (302, " ".join(words(30_000)), "en", "big"),
            (303, "one", "en", "tiny"), (None, "x y z", "en", "b"), out[5], out[5], (6, "other text", "en", "b")]
    return out


def words_of(df):
    return df.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))


def test_targets_and_taken_words(docs, rows):
    got = mixing.taken(words_of(docs(rows)), block=16).collect()
    assert len(got) == len(rows)
    by_id = {}
    for i, t, _, s in rows:
        by_id.setdefault((i, len((t or "").split())), []).append(s)
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want, taken = targets(sizes), {s: 0 for s in sizes}
    for r in got:
        s = by_id[(r.doc_id, r.size)].pop()
        assert r.source_size == sizes[s] and math.isclose(r.target, want[s], rel_tol=1e-9)
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 16 * 2


def test_reruns_agree_in_any_partitioning(docs, rows):
    a = sorted(map(str, mixing.taken(words_of(docs(rows))).collect()))
    b = sorted(map(str, mixing.taken(words_of(docs(rows[::-1]).repartition(7))).collect()))
    assert a == b


def test_texts_hold_the_words_taken(docs, rows):
    df = docs(rows, n_chars=0, _size=1, _h1=2, _h2=3, _p=4, row=5, mixed=6, _rank=7, _start=8)
    got = mixing.mix_texts(df, block=16).collect()
    count = {}
    for r in got:
        assert r.asDict().keys() == set(df.columns) and r.n_chars == len(r.text)
        whole = [t for i, t, _, s in rows if i == r.doc_id and s == r.source and t]
        n = len(r.text.split())
        assert any(n <= len(t.split()) and set(r.text.split()) <= set(t.split()) for t in whole)
        count[r.source] = count.get(r.source, 0) + n
    sums = {}
    for r in mixing.taken(words_of(df), block=16).collect():
        sums[r.source_size] = sums.get(r.source_size, 0) + r.taken
    assert sorted(count.values()) == sorted(v for v in sums.values() if v)


def test_permutation():
    for n in (1, 2, 3, 10, 64, 65, 1000):
        for key in (1, 7, 12345):
            assert sorted(mixing.permute(np.arange(n), n, key)) == list(range(n))
    assert list(mixing.permute(np.arange(100), 100, 1)) != list(mixing.permute(np.arange(100), 100, 2))


def test_shards_draw_alike_alone_and_together(monkeypatch):
    quotas = [5000, 0, 1234, 7, 9000]
    every = mixing.shard_counts(quotas, 0, 10**6, shard=100)
    assert sum(c for _, c, _ in every).tolist() == quotas
    at = np.zeros(5, np.int64)
    for s, c, start in every:
        assert (start == at).all() and c.sum() == min(100, sum(quotas) - 100 * s)
        at += c
        (one,) = mixing.shard_counts(quotas, s, s + 1, shard=100)
        assert one[0] == s and (one[1] == c).all() and (one[2] == start).all()
    monkeypatch.setattr(mixing, "DRAWN_UP_TO", 1000)
    assert sum(c for _, c, _ in mixing.shard_counts(quotas, 0, 10**6, shard=100)).tolist() == quotas


def test_shards_are_mixed():
    """Each shard's counts scatter around the quotas' shares as a draw would."""
    quotas = [40_000, 20_000, 40_000]
    share = np.array([c / c.sum() for _, c, _ in mixing.shard_counts(quotas, 0, 10**6, shard=1000)])
    assert np.abs(share.mean(axis=0) - [0.4, 0.2, 0.4]).max() < 1e-9
    assert 0.008 < share[:, 0].std() < 0.025


def test_empty_tables(docs):
    assert mixing.taken(words_of(docs([]))).collect() == []
    assert mixing.mix_texts(docs([])).collect() == []
    got = mixing.taken(words_of(docs([(1, None, "en", "a"), (2, "", "en", None)]))).collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in got) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_query(spark, tables):
    rows = spark.read.parquet(f"{tables}/documents.parquet").collect()
    sizes, source = {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").encode().split())
        source[r.doc_id] = r.source
    want, taken = targets(sizes), {s: 0 for s in sizes}
    got = queries.op8_mixing(spark, tables).collect()
    assert len(got) == len(rows)
    for r in got:
        assert math.isclose(r.target, want[source[r.doc_id]], rel_tol=1e-9) and r.taken <= 2 * r.size
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.03 * want[s] for s in sizes)


def test_small_sources_reach_their_targets(docs):
    """Sources of a short block or two, relative to their targets."""
    tail = {f"s{n}": n for n in (1, 10, 15, 31, 40, 65, 130)}
    rows = [(i, " ".join(["w"] * n), "en", s) for i, (s, n) in enumerate(tail.items())]
    rows += [(100 + i, " ".join(["w"] * 5000), "en", "a") for i in range(4)]
    got = [r for r in mixing.taken(words_of(docs(rows))).collect() if r.doc_id < 100]
    assert len(got) == len(tail)
    for r in got:
        assert r.target == 2 * r.size == r.taken
    for size in (10, 15, 31, 40, 65, 130, 1000):
        for target in (size / 2, size, 1.5 * size, 2 * size):
            blocks, slots = mixing._quota(size, target, 64)
            assert abs(slots * size / blocks - target) <= size / blocks / 2 + 1e-9


def test_large_draws_follow_the_distribution():
    """Against exact probabilities, and against mean and spread of large numbers."""
    rng = np.random.default_rng(1)
    for good, bad, sample in ((7, 12, 9), (3, 40, 20), (300, 200, 250)):
        got = np.bincount([mixing._hypergeometric(rng, good, bad, sample) for _ in range(20_000)], minlength=good + 1)
        want = [math.comb(good, k) * math.comb(bad, sample - k) / math.comb(good + bad, sample) if k <= sample else 0
                for k in range(good + 1)]
        assert np.abs(np.cumsum(got) / 20_000 - np.cumsum(want)).max() < 0.015
    good, bad, sample = 3 * 10**12, 5 * 10**12, 4 * 10**12
    z = (np.array([mixing._hypergeometric(rng, good, bad, sample) for _ in range(4000)]) - sample * 3 / 8) \
        / math.sqrt(sample / 2 * (3 / 8) * (5 / 8))
    assert abs(z.mean()) < 0.08 and abs(z.std() - 1) < 0.05


def test_upper_levels_are_drawn():
    """A range of more slots than numpy draws is not split in proportion."""
    quotas = [600_000_000, 400_000_000]
    firsts = {int(mixing.shard_counts(quotas, 0, 1, 500_000_000, seed)[0][1][0]) for seed in range(5)}
    assert len(firsts) == 5 and all(abs(x - 300_000_000) < 6 * math.sqrt(500_000_000 * 0.12) for x in firsts)
