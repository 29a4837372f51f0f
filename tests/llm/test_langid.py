import zlib

import numpy as np
import pytest

from pressio.llm import langid, queries

TEXTS = {"aa": "the cat sat on the mat and then the dog came to the door",
         "bb": "der hund und die katze saßen auf der matte neben der tür",
         "cc": "кот сидел на коврике и потом собака подошла к двери"}


def rows(n=60):
    out = []
    for i in range(n):
        lang = ("aa", "bb", "cc")[i % 3]
        w = TEXTS[lang].split()
        out.append((i, " ".join(w[(i + k * 7) % len(w)] for k in range(5 + i % 9)), lang))
    return out


@pytest.fixture(scope="module")
def model():
    return langid.train([t for _, t, _ in rows()], [y for *_, y in rows()])


def test_prediction_does_not_depend_on_the_batch(model):
    texts = [t for _, t, _ in rows()] + [None, "", "a", "12 3!", "ß", "é " * 40_000]
    langs, scores = langid.predict(model, texts)
    for t, y, s in zip(texts, langs, scores):
        one, score = langid.predict(model, [t])
        assert one == [y] and abs(score[0] - s) < 1e-6
        by_hand = langid.features(t) if langid.has_letter(t) else None
        if by_hand:
            u, c = by_hand
            p = langid._softmax((c @ model.table[u].astype(np.float64) + model.bias) / model.temperature)
            assert abs(p.max() - s) < 1e-4


def test_texts_without_letters_are_unknown(model):
    langs, scores = langid.predict(model, [None, "", " \n", "123 ²½ !?", "_"])
    assert langs == ["und"] * 5 and not scores.any()


def test_tables(spark, docs):
    data = [(i, t, y) for i, t, y in rows()]
    df = docs(data + [(100, None, "aa"), (101, "??", "bb"), (102, "x" * 100_000, None), (None, "the dog", "aa"),
                      data[0]], score=1, lang_pred="q")
    m = langid.fit(df)
    got = langid.identify(df, m).collect()
    assert len(got) == len(data) + 5
    by = {r.doc_id: r for r in got}
    assert np.mean([by[i].lang_pred == y for i, _, y in data]) > 0.95
    assert by[100].lang_pred == by[101].lang_pred == "und" and by[100].rejected and by[100].score == 0
    assert all(0 <= r.score <= 1 for r in got)


def test_nothing_to_learn_from(docs):
    df = docs([(1, "the dog", None)])
    assert langid.fit(df) is None
    assert [r.lang_pred for r in langid.identify(df, None).collect()] == ["und"]
    assert langid.identify(docs([]), langid.fit(docs([]))).collect() == []


def test_one_language(docs):
    df = docs([(i, "the dog", "aa") for i in range(5)])
    assert {r.lang_pred for r in langid.identify(df, langid.fit(df)).collect()} == {"aa"}


def test_held_out_accuracy_and_calibration(spark, tables):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    got = queries.op7_language_id(spark, tables).collect()
    assert len(got) == len(truth)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in got if r.held_out]
    right = np.array([r.lang_pred == truth[r.doc_id] for r in held])
    score = np.array([r.score for r in held])
    assert right.mean() >= 0.97
    assert abs(right.mean() - score.mean()) < 0.05
    sure = ~np.array([r.rejected for r in held])
    assert right[sure].mean() >= 0.97
