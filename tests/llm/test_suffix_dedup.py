import hashlib
import random

import pytest

from pressio.llm import queries, suffix_dedup


def brute(rows, length=100):
    """rows of distinct ids: (n_bytes, n_removed, n_spans, kept)."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        b = (text or "").encode()
        hit = bytearray(len(b))
        for k in range(len(b) - length + 1):
            w = b[k:k + length]
            if w in seen:
                hit[k:k + length] = b"\1" * length
            seen.add(w)
        spans = sum(1 for k in range(len(b)) if hit[k] and (k == 0 or not hit[k - 1]))
        out[i] = (len(b), sum(hit), spans, bytes(c for c, h in zip(b, hit) if not h))
    return out


def found(df, length=100):
    rows = suffix_dedup.remove_repeats(df, length=length).collect()
    return rows, {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows}


def corpus(seed, n=60):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("ab ") for _ in range(rnd.choice([150, 400]))) for _ in range(4)]
    base += ["é" * 300, "xy" * 200, " " * 250, "abc" * 90]

    def piece():
        x = rnd.choice(base)
        a = rnd.randrange(len(x))
        return x[a:a + rnd.randint(1, 300)]
    rows = [(i, "".join(piece() for _ in range(rnd.randint(0, 5)))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, "a" * 99), (n + 3, "b" * 20_000)]


@pytest.mark.parametrize("small", [False, True])
def test_equal_to_brute_force(docs, monkeypatch, small):
    if small:  # texts in many pieces, chunks of few texts
        monkeypatch.setattr(suffix_dedup, "PIECE", 37)
        monkeypatch.setattr(suffix_dedup, "CHUNK", 500)
    rows = corpus(3 + small)
    _, got = found(docs(rows))
    assert got == brute(rows)


def test_another_length(docs):
    rows = corpus(9, 20)
    _, got = found(docs(rows), 40)
    assert got == brute(rows, 40)


def test_passage_that_all_documents_share(docs):
    rnd = random.Random(0)
    passage = "".join(rnd.choice("abcdef ") for _ in range(260))
    rows = [(i, f"{rnd.random()}{passage}{rnd.random()}") for i in range(300)]
    _, got = found(docs(rows))
    assert got == brute(rows)
    assert sum(x[1] > 0 for x in got.values()) == 299


def test_rows_that_share_an_id_and_null_ids(docs):
    a, b = "q" * 30 + "".join(map(str, range(80))), "".join(map(str, range(300, 380)))
    rows, got = found(docs([(1, a), (1, a), (2, a + b), (None, a), (3, b), (3, b + a)]))
    assert len(rows) == 6
    assert [(r.n_removed, bytes(r.kept).decode()) for r in rows if r.doc_id is None] == [(0, a)]
    assert {r.n_removed for r in rows if r.doc_id == 1} == {0}
    assert got[2][1] == len(a)
    assert sorted(r.n_removed for r in rows if r.doc_id == 3) == sorted([len(b), len(a + b)])


def test_empty_table(docs):
    assert found(docs([]))[0] == []


def test_every_window_has_its_phrase():
    import numpy as np
    rnd = random.Random(4)
    raw = np.frombuffer(bytes(rnd.choice(b"abc") for _ in range(5000)), np.uint8)
    t, s, n = suffix_dedup.parse(raw)
    assert s[0] == 0 and (s[1:] == (s + n)[:-1]).all() and s[-1] + n[-1] == len(raw) - 99


def test_query(spark, tables):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{tables}/documents.parquet").collect()]
    want = brute(rows)
    got = queries.op9_suffix_dedup(spark, tables).collect()
    assert len(got) == len(want)
    for r in got:
        n, removed, spans, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (
            n, removed, spans, hashlib.sha256(kept).hexdigest())
