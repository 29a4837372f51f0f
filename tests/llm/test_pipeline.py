import re

import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as P
from pressio.llm import minhash, quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before the first stage and after each."""
    import os
    import tempfile
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        pytest.skip("driver tables not available")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        path = tempfile.mkdtemp(prefix="pipeline-") + "/x"
        stage(spark, out[-1], sf).write.parquet(path)
        out.append(spark.read.parquet(path))
    return sf, [x.collect() for x in out], [x.columns for x in out]


def test_stages_are_named_and_ordered():
    assert [n for n, _ in P.STAGES] == ["quality classifier", "line dedup", "MinHash near-dedup",
                                        "mixing sources", "BPE encoding"]


def test_all_but_the_last_return_documents(stages):
    _, _, columns = stages
    assert all(c == COLUMNS for c in columns[:-1])


def test_rejected_documents_go(spark, stages):
    sf, rows, _ = stages
    judged = quality.judge(spark.read.parquet(f"{sf}/documents.parquet"),
                           spark.read.parquet(f"{sf}/labels.parquet")).collect()
    assert {r.doc_id for r in rows[1]} == {r.doc_id for r in judged if r.kept}
    before = {r.doc_id: r for r in rows[0]}
    assert all(before[r.doc_id] == r for r in rows[1])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r.doc_id for r in rows[1]}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.98 * len(good)


def test_repeated_lines_go_and_first_ones_stay(stages):
    _, rows, _ = stages
    before = {r.doc_id: r for r in rows[1]}
    assert {r.doc_id for r in rows[2]} == set(before)
    left = {r.doc_id: r.text.split("\n") for r in rows[2]}
    assert all(set(x) <= set(before[i].text.split("\n")) for i, x in left.items() if x != [""])
    lines = [" ".join(re.findall(r"[^\W_]+", x.lower())) for t in left.values() for x in t]
    lines = [x for x in lines if x]
    assert len(lines) == len(set(lines))


def test_one_document_of_each_group_stays(spark, stages):
    _, rows, _ = stages
    df = spark.createDataFrame([(r.doc_id, r.text) for r in rows[2]], "doc_id long, text string")
    groups = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, percent=80).collect()}
    assert {r.doc_id for r in rows[3]} == set(groups.values())


def test_mix_takes_words_of_every_source(stages):
    _, rows, _ = stages
    text = {r.doc_id: r.text.split() for r in rows[3]}
    assert {r.source for r in rows[4]} == {r.source for r in rows[3] if r.text.split()}
    for r in rows[4]:
        words = r.text.split()
        assert 0 < len(words) <= len(text[r.doc_id]) and set(words) <= set(text[r.doc_id])
    total = sum(len(r.text.split()) for r in rows[4])
    assert abs(total - 1.5 * sum(map(len, text.values()))) <= 64 * len({r.source for r in rows[3]})


def test_ids_are_those_of_the_texts(stages):
    import public_tokenizers
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    _, rows, _ = stages
    want = sorted((r.doc_id, tok.encode(r.text, add_special_tokens=False).ids) for r in rows[4])
    assert sorted((r.doc_id, r.ids) for r in rows[5]) == want
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows[5])


def test_stages_take_empty_and_odd_documents(spark, stages):
    sf, *_ = stages
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "some words of a text", "en", None, 20),
           (3, "some words of a text", "en", "a", 20), (3, "some words of a text", "en", "a", 20)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, kind)
        for _, stage in P.STAGES:
            docs = spark.createDataFrame(stage(spark, docs, sf).collect(),
                                         stage(spark, docs, sf).schema)
        docs.count()


def test_registered(spark):
    names = E.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in names} and "pipeline" in names
    assert set(E.oracle_sql()) <= set(names)
