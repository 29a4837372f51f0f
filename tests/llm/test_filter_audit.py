"""The audit of filters against a plain version."""

import random
import re
from collections import Counter
from itertools import permutations

from pressio.llm import filter_audit
from pressio.llm._common import drop_folder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
           "shapley"]


def plain(rows, labels):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    docs = []
    for i, t, s in rows:
        t = t or ""
        words = WORD.findall(t)
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": i is not None and first[t] < i}
        marks = [x for x in labels if x[0] == i and i is not None]
        docs.append((s or "", {f for f in fails if fails[f]}, any(x[1] == 1 for x in marks), any(x[2] == 1 for x in marks)))
    out = []
    for part in {d[0] for d in docs}:
        mine, removed_by = [d for d in docs if d[0] == part], Counter()
        steps = []
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                before = [d for d in mine if not d[1] & set(order[:k])]
                gone = [d for d in before if f in d[1]]
                removed_by[f] += len(gone)
                steps.append((part, "".join(order), k + 1, len(before) - len(gone), len(gone),
                              sum(f in d[1] for d in mine) - len(gone), sum(d[1] == {f} for d in mine),
                              sum(d[2] for d in gone), sum(d[3] for d in gone), f))
        out += [(*s[:-1], removed_by[s[-1]]) for s in steps]
    return sorted(out)


def found(spark, df, labels):
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return sorted(tuple(r) for r in filter_audit.audit(filter_audit.patterns(df, marks)).select(*COLUMNS).collect())


def test_audit_equals_a_plain_version(spark, docs):
    random.seed(5)
    kinds = [lambda: " ".join(random.choices("abcdefgh", k=80)), lambda: " ".join(f"w{i}" for i in range(70)),
             lambda: "UP " * 60, lambda: "x $ y", lambda: None, lambda: "", lambda: "ÄÖ " * 55 + "Z",
             lambda: "\x85   é\xa0é\tx\x0by\x0cz\r" * 30, lambda: "same text"]
    rows = [(random.choice([i, i, 7, None]), random.choice(kinds)(), random.choice(["s", "t", None, ""]))
            for i in range(150)]
    rows += [(900, "word " * 40_000, "s"), (901, "word " * 40_000, "u")]
    labels = [(random.randint(0, 150), random.choice([0, 1, None]), random.choice([0, 1, None])) for _ in range(120)]
    df = docs([(i, t, None, s) for i, t, s in rows], words=1, shard="x", row=2, text0=3, doc_key=4)
    assert found(spark, df, labels) == plain(rows, labels)


def test_empty_tables(spark, docs):
    assert found(spark, docs([]), []) == []
    assert found(spark, docs([(1, "x", None, "s")]), []) == plain([(1, "x", "s")], [])


def test_matrix_holds_the_terms(spark, docs, words, monkeypatch):
    monkeypatch.setattr(filter_audit, "SHARD", 500)  # many shards
    texts = {i: " ".join(words(i % 40)) for i in range(120)}
    shards, dictionary, path = filter_audit.term_matrix(docs(list(texts.items())).select("doc_id", "text"))
    names = {r["id"]: bytes(r["word"]).decode() for r in dictionary.collect()}
    assert sorted(names) == list(range(len(names))) and len(set(names.values())) == len(names)
    got = {}
    shard_rows = shards.collect()
    assert len(shard_rows) > 10
    for s in shard_rows:
        for i, row in enumerate(s["rows"]):
            a, b = s["ends"][i], s["ends"][i + 1]
            assert s["columns"][a:b] == sorted(s["columns"][a:b])
            got[row["doc_id"]] = {names[c]: n for c, n in zip(s["columns"][a:b], s["counts"][a:b])}
    assert got == {i: dict(Counter(t.split())) for i, t in texts.items()}
    drop_folder(spark, path)


def test_words_of_many_shards_have_one_number(spark, docs, monkeypatch):
    monkeypatch.setattr(filter_audit, "PACK", 64)
    texts = [(i, f"common word{i % 9} and more") for i in range(300)]
    shards, dictionary, _ = filter_audit.term_matrix(docs(texts).repartition(9).select("doc_id", "text"))
    assert dictionary.count() == 3 + 9
    sums = filter_audit.row_sums(shards).select("row.doc_id", "n_words", "n_distinct").collect()
    assert sorted(tuple(r) for r in sums) == [(i, 4, 4) for i in range(300)]


def test_pieces_of_a_shard_make_the_rows_of_the_whole():
    import numpy as np
    import pyarrow as pa

    def dense(ends, columns, counts, words):
        words = words.to_pylist()
        return [{words[c]: int(n) for c, n in zip(columns[i:j], counts[i:j])} for i, j in zip(ends, ends[1:])]

    texts = pa.array(["a b a", None, "", " c\td  b ", "é a a a", "b"])
    whole = dense(*filter_audit._entries(texts))
    pieces = [filter_audit._entries(texts.slice(i, n)) for i, n in ((0, 2), (2, 1), (3, 3))]
    ends, columns, counts, words = filter_audit._joined(pieces)
    assert dense(ends, columns, counts, words) == whole
    assert len(set(words.to_pylist())) == len(words) and np.asarray(ends).dtype == np.int32
    assert filter_audit.PIECE < filter_audit.SHARD


def test_words_are_dealt_packed():
    """A row a shard and part, not one a word; a word is in the same part wherever it is listed."""
    import numpy as np
    import pyarrow as pa

    def dealt(words):
        raw, sizes = filter_audit._raw(pa.array(words, pa.binary()))
        order = np.argsort(filter_audit._hashes(raw, sizes), kind="stable")
        words = [words[i] for i in order]
        raw, sizes = filter_audit._raw(pa.array(words, pa.binary()))
        shard = pa.RecordBatch.from_arrays(
            [pa.array([4]), pa.array([raw.tobytes()], pa.binary()), pa.array([sizes.tobytes()], pa.binary())],
            ["shard", "words", "sizes"])
        rows = [r for b in filter_audit._dealt(iter([shard]), 7) for r in b.to_pylist()]
        found = {}
        for r in rows:
            mine = filter_audit._words(r["words"], np.frombuffer(r["sizes"], np.int32)).to_pylist()
            assert r["shard"] == 4 and words[r["at"]:r["at"] + len(mine)] == mine
            found |= dict.fromkeys(mine, r["part"])
        assert len(rows) == len(set(found.values())) <= 7 and set(found) == set(words)
        return found
    words = [f"wörd{i}".encode() for i in range(3000)] + [b"x" * 5000, b"a", b"aa", b"\x00"]
    parts = dealt(words)
    assert all(parts[w] == p for w, p in dealt(words[::-3]).items())
    assert min(Counter(parts.values()).values()) > 300 and dealt([]) == {}


def test_shards_are_filled_over_batches(spark, docs, monkeypatch):
    monkeypatch.setattr(filter_audit, "TEXTS", 20)
    shards, _, path = filter_audit.term_matrix(
        docs([(i, f"a b{i}") for i in range(200)]).coalesce(1).select("doc_id", "text"))
    assert shards.count() == 1
    drop_folder(spark, path)


def test_signs_as_regular_expressions_find_them():
    import pyarrow as pa

    random.seed(3)
    texts = [None, "", "A", "é" * 19 + "A", "é" * 18 + "A", "|"]
    texts += ["".join(random.choices("abcÄé界 \nXYZ#*", [9, 9, 9, 9, 9, 9, 9, 9, .5, .5, .5, .2, .2], k=40)) for _ in range(300)]
    want = [4 * (100 * len(re.findall("[A-Z]", t or "")) > 5 * len(t or "")) + 8 * bool(re.search(r"[#$%&*|]", t or ""))
            for t in texts]
    assert filter_audit._signs(pa.array(texts)).tolist() == want
    assert filter_audit._signs(pa.array(texts).slice(2, 50)).tolist() == want[2:52]
