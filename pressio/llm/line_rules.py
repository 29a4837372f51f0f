"""Line-first cleaning, with DataFrame functions only.

Every line of a text is judged by three rules; lines that fail one are
removed, and a document that loses too much of its text by that is rejected.

* punctuation: a line of prose ends with a full stop, an exclamation or
  question mark or an ellipsis, closing quotes and brackets aside, and fewer
  than ``DECORATED`` per cent of its words carry runs of signs ("buy!! now$$$");
* navigation: a line is no chain of entries (``CHAIN`` separators or more, one
  to every ``ENTRY`` words at least) and, up to ``MENU_CHARS`` characters, does
  not consist of menu words alone;
* boilerplate: a line holds no phrase of ``BOILERPLATE`` and no brace.

Words are ``[^\\x20\\x09-\\x0D]+``, lines what lies between line feeds. A line
without a word is kept and counts nothing. A document is judged by its words'
characters: it is rejected if more than ``MOST_LOST`` per cent of them are in
removed lines. Before that, too short and too repetitive documents are
rejected (``LEAST_WORDS``, ``MOST_REPEATED``): repeated are the words that lie
in windows of three words found twice or more in the text, which are told by
64-bit hashes.

Every document is judged by its own row alone: nothing is shuffled, whatever
the rows of a source or group of copies are. A row's words are an array in
its task, about ten times the text's bytes.

Defined cases: a NULL or empty text has no words and no lines, fails the
base rules and is not kept (its cleaned text is NULL or empty as it was);
repeated rows and ids are judged row by row; an empty table gives no rows.
Columns of the input stay, but for those that have a result's name, which
the result replaces, whatever their case; other columns may have any name.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import WORD

LEAST_WORDS = 50
MOST_REPEATED = 50
MOST_LOST = 30
DECORATED = 30
CHAIN, ENTRY = 3, 4
MENU_CHARS = 200
SYMBOLS = "[#*$%&|<>]"
WHITE = r"[\x20\x09-\x0D]+"

# Regular expressions in the common part of Java's and RE2's syntax; MENU and
# BOILERPLATE hold for A-Z as for a-z (as Java takes "(?i)").
ENDS = r"""[.!?…。！？]["'”’»)\]]*[\x20\x09-\x0D]*\z"""
RUNS = r"[!?#*$%&|<>]{2,}"
SEPARATORS = r"(^|[\x20\x09-\x0D])[|>»›·•]+([\x20\x09-\x0D]|\z)"
MENU = (r"^[\x20\x09-\x0D]*((home|menu|next|previous|prev|back|login|log in|logout|register|sign in|sign up|search|"
        r"share|tweet|print|contact|contact us|about|about us|sitemap|read more|top)[\x20\x09-\x0D.,:!]*)+\z")
BOILERPLATE = (r"lorem ipsum|javascript|cookie policy|uses? cookies|privacy policy|terms of (use|service)|"
               r"all rights reserved|copyright (©|\(c\))|powered by|click here|subscribe to|[{}]")

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
RESULT = [*BASE, "n_lines", "n_removed_lines", "lost_chars", "kept"]


def line_fails(line: Column) -> dict[str, Column]:
    """What each rule says of a line with a word: true where it fails."""
    words = F.regexp_count(line, F.lit(WORD))
    decorated = F.regexp_count(line, F.lit(RUNS))
    between = F.regexp_count(line, F.lit(SEPARATORS))
    # words are counted only in lines with such signs
    return {"punctuation": ~line.rlike(ENDS) | ((decorated > 0) & (100 * decorated >= DECORATED * words)),
            "navigation": ((between >= CHAIN) & (ENTRY * between >= words))
                          | ((F.length(line) <= MENU_CHARS) & line.rlike("(?i)" + MENU)),
            "boilerplate": line.rlike("(?i)" + BOILERPLATE)}


def _has_word(line: Column) -> Column:
    return line.rlike(WORD)


def _fails(line: Column) -> Column:
    return reduce(or_, line_fails(line).values())


def _repeated(windows: Column) -> Column:
    """Number of words in the windows (hash, place) that have an equal one."""
    def same(x, at):
        return F.coalesce(F.get(windows, at)["h"] == x["h"], F.lit(False))
    # an index of -1 is out of range, as one past the end is
    starts = F.array_sort(F.transform(
        F.filter(windows, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"]))
    return starts


def judged(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``RESULT`` and ``clean``: the text without failed lines."""
    rest = [c for c in docs.columns if c.lower() not in {*RESULT, "clean"}]
    named = docs.select(F.struct(*rest).alias("row"), F.col(text).alias("text0"))
    split = named.select("row", "text0", F.coalesce("text0", F.lit("")).alias("t")).select(
        "row", "text0", "t", F.array_remove(F.split("t", WHITE), "").alias("w"),
        F.filter(F.split("t", "\n"), _has_word).alias("lines"))
    # a window is a hash of its three words; those beyond the last word are NULL
    hashed = split.select("*", F.when(F.size("w") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("w") - 3),
        lambda i: F.xxhash64(F.get(F.col("w"), i), F.get(F.col("w"), i + 1), F.get(F.col("w"), i + 2)))
    ).otherwise(F.array().cast("array<bigint>")).alias("h"))
    # most texts repeat no window: only the others sort theirs
    sorted_ = hashed.select("*", F.when(
        F.size(F.array_distinct("h")) < F.size("h"),
        F.array_sort(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("windows"))
    starts = sorted_.select("*", _repeated(F.col("windows")).alias("at"))
    covered = F.aggregate(
        F.transform("at", lambda x, i: F.least(F.lit(3), F.coalesce(F.get(F.col("at"), i + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    # a generator of one row: a filter on the results is not evaluated anew below it
    base = starts.select(F.inline(F.array(F.struct(
        "row", "text0", "t", "lines", F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).alias("n_repeat_words"), F.filter("lines", _fails).alias("failed")))))
    lost = base.select("*", F.size("lines").cast("long").alias("n_lines"),
                       F.size("failed").cast("long").alias("n_removed_lines"),
                       F.length(F.regexp_replace(F.array_join("failed", ""), WHITE, "")).cast("long").alias("lost_chars"),
                       ((F.col("n_words") < LEAST_WORDS)
                        | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))).alias("base_failed"))
    clean = F.array_join(F.filter(F.split("t", "\n"), lambda x: ~(_has_word(x) & _fails(x))), "\n")
    return lost.select(
        *[F.col("row")[c].alias(c) for c in rest], *[c for c in RESULT if c != "kept"],
        (~F.col("base_failed") & (100 * F.col("lost_chars") <= MOST_LOST * F.col("word_chars"))).alias("kept"),
        F.when(F.col("n_removed_lines") == 0, F.col("text0")).otherwise(clean).alias("clean"))


def clean_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are kept, their text without failed lines; other
    columns as they were."""
    names = docs.columns
    ours = docs.select(F.struct(*names).alias("row"), F.col(text).alias("body"))
    found = judged(ours, "body").filter("kept")
    return found.select(*[F.col("clean").alias(c) if c == text else F.col("row")[c].alias(c) for c in names])
