"""Line-first cleaning against a plain version."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pressio.llm import line_rules
from pressio.llm.line_rules import BOILERPLATE, CHAIN, DECORATED, ENDS, ENTRY, MENU, MENU_CHARS, MOST_LOST, RUNS, SEPARATORS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "Plain words that end as prose does, again and again, in one line. " * 3


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + d for i, w in enumerate(windows) if times[w] > 1 for d in range(3)}

    def fails(x):
        low, n = re.sub("[A-Z]", lambda m: m[0].lower(), x), len(WORD.findall(x))
        between = len(list(re.finditer(SEPARATORS.replace(r"\z", r"\Z"), x)))
        return (not re.search(ENDS.replace(r"\z", r"\Z"), x) or 100 * len(re.findall(RUNS, x)) >= DECORATED * n
                or (between >= CHAIN and ENTRY * between >= n)
                or (len(x) <= MENU_CHARS and re.search(MENU.replace(r"\z", r"\Z"), low)) or re.search(BOILERPLATE, low))
    gone = [x for x in lines if fails(x)]
    chars, lost = sum(map(len, words)), sum(len("".join(WORD.findall(x))) for x in gone)
    base = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    clean = "\n".join(x for x in text.split("\n") if x not in gone)
    return (len(words), chars, len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), base,
            len(lines), len(gone), lost, not base and 100 * lost <= MOST_LOST * chars), clean


def rows_of(df):
    return [tuple(r[c] for c in ("doc_id", *line_rules.RESULT, "clean")) for r in df.collect()]


def test_cases_equal_a_plain_version(docs):
    random.seed(3)
    vocabulary = ["alpha", "beta", "Größe", "naïve", "🙂", "a|b", "x$", "go!!", "now$$$", "|", "»", "home", "cookie"]
    texts = [None, "", " \t\r\n", "one", LONG, LONG * 4, "a a a a a", "x y z\nx y z\n\nx y z ", "Home\nNext. Previous",
             LONG + "\nhome next Login\n" + LONG, "a | b | c | d\n" + LONG * 2, "This site uses cookies.\n" + LONG * 2,
             "function() { return; }\n" + LONG * 2, "All Rights Reserved. \n" + LONG * 3, "no end\n" + LONG * 2,
             "“Quoted.” \n" + LONG * 2, "buy!! now$$$ here.\n" + LONG * 2, "home " * 3000, "long. " * 20000]
    for _ in range(80):
        texts.append("\n".join(" ".join(random.choices(vocabulary, k=random.randint(0, 30))) + random.choice([".", "", "!"])
                               for _ in range(random.randint(1, 9))))
    for _ in range(20):
        texts.append("\n".join(" ".join(random.choices(["ab", "c", "d", "e"], k=20)) + "." for _ in range(4)))
    expected = [(i, *plain(x)[0], None if x is None else plain(x)[1]) for i, x in enumerate(texts)]
    got = sorted(rows_of(line_rules.judged(docs([(i, x) for i, x in enumerate(texts)]))))
    for e, g in zip(expected, got):
        assert e == g, (e, g)
    assert len(got) == len(expected)


def test_repeated_rows_and_null_ids_are_judged_row_by_row(docs):
    got = rows_of(line_rules.judged(docs([(1, LONG * 2), (1, LONG * 2), (None, "x"), (2, LONG)])))
    assert sorted((r[0] is None, r[0]) for r in got) == [(False, 1), (False, 1), (False, 2), (True, None)]


def test_empty_table_and_clashing_columns(docs):
    assert line_rules.judged(docs([])).count() == 0
    df = docs([(1, LONG * 2 + "\nmenu")], **{"n_words": 7, "row": 8, "w": 9, "Clean": "x", "lines": 3})
    out = line_rules.judged(df)
    first = out.first()
    assert first["n_words"] == len((LONG * 2).split()) + 1 and first["lines"] == 3 and first["row"] == 8
    assert [c.lower() for c in out.columns].count("clean") == 1


def test_clean_documents_keep_columns_and_lose_failed_lines(docs):
    first, last = (" ".join(f"{x}{i}" for i in range(60)) + "." for x in "vw")
    df = docs([(1, first + "\nHome | Next | Back | Login\n\n" + last), (2, "short."), (3, None)])
    out = line_rules.clean_documents(df)
    assert out.columns == df.columns
    assert [(r["doc_id"], r["text"]) for r in out.collect()] == [(1, first + "\n\n" + last)]


def test_no_python_and_no_shuffle(spark, tables):
    plan = line_rules.judged(spark.read.parquet(f"{tables}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("quality,least,most", [(1, 0.95, 1.0), (0, 0.0, 0.2)])
def test_good_documents_stay(spark, tables, quality, least, most):
    got = line_rules.judged(spark.read.parquet(f"{tables}/documents.parquet")).filter("not base_failed")
    labels = spark.read.parquet(f"{tables}/labels.parquet").filter(F.col("quality") == quality)
    share = got.join(labels, "doc_id").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert least <= share <= most
