import random

import duckdb
import numpy as np
import pytest

from pressio.llm import buckets, minhash, oracles, queries


def brute(rows, percent=85):
    sets = {}
    for i, text in rows:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
        s = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.setdefault(i, []).append(s)
    ids = sorted(x for x in sets if x is not None)
    comp = {i: i for i in ids}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for a in ids:
        for b in ids:
            if a < b and any(100 * len(x & y) >= percent * len(x | y) > 0 for x in sets[a] for y in sets[b]):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    return {i: root(i) for i in ids}


def near(words, rnd, n):
    w = list(words)
    for _ in range(n):
        w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture
def corpus(words):
    rnd = random.Random(3)
    rows, i = [], 0
    for size in (60, 200, 400):
        for _ in range(4):
            base = words(size)
            for edits in (0, 0, 1, 1, 2, 3, 5, 8):
                rows.append((i, near(base, rnd, edits)))
                i += 1
    rows += [(i, None), (i + 1, ""), (i + 2, " \t\n"), (i + 3, "One two"), (i + 4, "one  TWO\n"),
             (i + 5, "one two three"), (i + 6, "É a b c d e"), (i + 7, "é a b c d e"),
             (i + 8, " ".join(words(20_000))), (None, "one two"), (i + 3, "One two"), (0, rows[9][1])]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("percent", [85, 80])
def test_components_equal_brute_force(docs, corpus, percent):
    got = minhash.near_duplicates(docs(corpus), percent=percent).collect()
    assert len(got) == len(corpus)
    want = brute(corpus, percent)
    for r in got:
        assert r.component_id == want.get(r.doc_id)
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)


def test_a_large_group_of_near_copies_is_solved_in_cells(docs, words, monkeypatch):
    """Two edits of 60 words part most copies from each other: many outsiders, few
    links. Blocks of three members, and of one long text."""
    monkeypatch.setattr(buckets, "BLOCK_ROWS", 3)
    monkeypatch.setattr(buckets, "BLOCK_SIZE", 400)
    rnd = random.Random(5)
    base, other = words(60), words(700)
    rows = [(i, near(base, rnd, 2)) for i in range(80)] + [(i, near(other, rnd, 6)) for i in range(80, 100)]
    want = brute(rows)
    assert 20 < len(set(want.values())) < 100
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs(rows)).collect()} == want


def test_one_row_of_each_group(docs, corpus):
    left = minhash.distinct_documents(docs(corpus), percent=85).collect()
    want = brute(corpus)
    ids = [r.doc_id for r in left]
    assert sorted(x for x in ids if x is not None) == sorted({c for c in want.values()})
    assert ids.count(None) == 1


def test_empty_table(docs):
    assert minhash.near_duplicates(docs([])).collect() == []


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 62, 4000).astype(np.uint64)
    b = np.concatenate([a[:3000], rng.integers(0, 1 << 62, 1000).astype(np.uint64)])
    s = minhash.signatures([np.unique(a), np.unique(b)], 400)
    assert abs((s[0] == s[1]).mean() - 3000 / 5000) < 0.08


def test_bands_follow_from_the_threshold():
    for percent in (80, 85, 95):
        n = minhash.band_count(percent)
        assert (1 - (percent / 100) ** minhash.ROWS) ** n <= minhash.MISS


def test_query_equals_sql(spark, tables):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tables}/documents.parquet')")
    rel = con.execute(oracles.OP1)
    cols = [d[0] for d in rel.description]
    want = {r[cols.index("doc_id")]: dict(zip(cols, r)) for r in rel.fetchall()}
    got = queries.op1_minhash(spark, tables).collect()
    assert len(got) == len(want)
    assert all(want[r.doc_id] == r.asDict() for r in got)
