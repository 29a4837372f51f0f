"""Byte-level BPE encoding and decoding, long texts by tree concatenation.

A text of up to ``leaf`` characters is encoded in its row. A longer one is
cut into leaves of that length at any character, the leaves are encoded in
parallel, and neighbours are joined level by level up a binary tree. At a
join, a window around the cut is encoded anew, and grown until it agrees
with what stands on both sides of it; its ids then replace those next to the cut.

Agreement is exact, not a heuristic. A position settles a side when it is

* a space after a non-space: every scan of the pre-tokenizer starts a piece
  there, so what is encoded on either side cannot depend on the other; or
* inside a run of letters, digits, marks or spaces, where both encodings end
  (left side) or begin (right side) a token, and it is the same token. A
  sequence of BPE tokens is the encoding of its text if every two neighbours
  are the encoding of theirs, so equal tokens at a seam make the whole right.

If no window settles, it ends up being both whole texts.

Defined cases: a NULL text has no ids and decodes to the empty text, as an
empty one; repeated texts are encoded once when long; the special token's
string in a text is its id, as the library does; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ._common import chunks, cut

LEAF = 65_536
WINDOW = 64
SPECIAL = "<|endoftext|>"
# Fixed value: the pre-tokenizer's pattern in the public vocabulary files.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Characters whose class no version of Unicode has changed.
LATIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\u017f\u2010-\u2027\u20ac]*")


class Codec:
    """The encoder of one byte-level vocabulary file of the tokenizers library.

    Texts of Latin letters and common signs, by far the most, go through
    tiktoken with the same vocabulary, which gives the same ids several times
    as fast; where the two libraries could class a character differently, or
    the special token's string occurs, the tokenizers library encodes.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        n = self.tok.get_vocab_size(with_added_tokens=True)
        added = self.tok.get_added_tokens_decoder()
        byte = {c: b for b, c in _byte_characters().items()}
        self.bytes = [bytes(byte[c] for c in self.tok.id_to_token(i)) for i in range(n)]
        self.lengths = np.array([len(x) for x in self.bytes], np.int64)
        self.special = [t.content for t in added.values()]
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"]["".join(m)] for m in pairs]
        self.fast = None
        if made == sorted(made):  # an id is then its merge's rank
            ranks = {self.bytes[i]: i for i in range(n) if i not in added}
            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks,
                                          special_tokens={})

    def encode_one(self, text: str) -> np.ndarray:
        if (self.fast and LATIN.fullmatch(text)
                and not any(s in text for s in self.special)):
            return np.array(self.fast.encode_ordinary(text), dtype=np.int32)
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype=np.int32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encode_one(t) for t in texts]

    def decode(self, ids: list[int]) -> str:
        of = self.bytes
        return b"".join([of[i] for i in ids]).decode("utf-8", "replace")


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary:
    a visible Latin-1 character for itself, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


def codec(path: str) -> Codec:
    """The codec of a file, one per worker process: tasks unpickle this
    function anew, so it is kept on a module that they all import."""
    import tokenizers
    kept = vars(tokenizers).setdefault("_codecs_by_path", {})
    if path not in kept:
        kept[path] = Codec(path)
    return kept[path]


def _kind(c: str) -> str:
    import unicodedata
    if c.isspace():
        return "space"
    k = unicodedata.category(c)[0]
    return {"L": "letter", "N": "number"}.get(k, "mark")


def _inside(text: str, p: int) -> bool:
    """Whether every scan that starts some characters earlier keeps p inside one piece."""
    if p < len(SPECIAL) + 4 or p > len(text) - len(SPECIAL) - 4:
        return False  # the special token's string could begin before the window or end after it
    kind = _kind(text[p])
    if kind == "space":
        return all(c.isspace() for c in text[p - 1:p + 2])
    if any(_kind(c) != kind for c in text[p - 4:p]):
        return False
    around = text[max(0, p - len(SPECIAL) + 1):p + len(SPECIAL) - 1]
    return SPECIAL not in around


def _seam(text: str, p: int) -> bool:
    return 0 < p < len(text) and text[p] in " \n" and not text[p - 1].isspace()


def _places(c: Codec, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offset of each character, and of each token, ends included."""
    chars = np.cumsum([0, *[len(x.encode()) for x in text]])
    return chars, np.concatenate([[0], np.cumsum(c.lengths[ids])])


def join(c: Codec, left: str, a: np.ndarray, right: str, b: np.ndarray,
         window: int = WINDOW) -> np.ndarray:
    """The ids of ``left + right`` from the ids of both."""
    if not left or not right:
        return a if left else b
    w = window
    while True:
        ltail, rhead = left[-w:], right[:w]
        text = ltail + rhead
        mid = len(ltail)
        ids = c.encode_one(text)
        chars, ends = _places(c, text, ids)
        tokens = {int(x): i for i, x in enumerate(ends)}
        # tokens of the left side by distance from its end, of the right from its start
        na = int(np.searchsorted(np.cumsum(c.lengths[a[::-1]]), len(ltail.encode()) + 1)) + 1
        ta, nb = a[len(a) - min(na, len(a)):], min(len(b), len(rhead.encode()))
        back = np.concatenate([[0], np.cumsum(c.lengths[ta[::-1]])])
        lpos = {int(chars[mid] - x): len(a) - i for i, x in enumerate(back)}
        rpos = {int(chars[mid] + x): i for i, x in
                enumerate(np.concatenate([[0], np.cumsum(c.lengths[b[:nb]])]))}
        p = _settled(text, chars, range(mid - 1, 0, -1), tokens, lpos, ids, a, True)
        q = _settled(text, chars, range(mid + 1, len(text)), tokens, rpos, ids, b, False)
        if len(ltail) == len(left):
            p = p if p is not None else (0, 0)
        if len(rhead) == len(right):
            q = q if q is not None else (len(ids), len(b))
        if p is not None and q is not None:
            return np.concatenate([a[:p[1]], ids[p[0]:q[0]], b[q[1]:]])
        w *= 2


def _settled(text, chars, where, tokens, side, ids, own, ends_here):
    """(token index in the window, in the side) of the place nearest the cut
    that settles a side, or None."""
    for p in where:
        at = int(chars[p])
        i, k = tokens.get(at), side.get(at)
        if i is None or k is None:
            continue
        if _seam(text, p):
            return i, k
        if _inside(text, p):
            if ends_here and i > 0 and k > 0 and ids[i - 1] == own[k - 1]:
                return i, k
            if not ends_here and i < len(ids) and k < len(own) and ids[i] == own[k]:
                return i, k
    return None


def _ids_column(found: list[np.ndarray]) -> pa.Array:
    off = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
    flat = np.concatenate(found) if found else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat.astype(np.int32, copy=False)))


def _with_ids(df: DataFrame, text: str, path: str, ids: str) -> DataFrame:
    """Encode each row's whole text."""
    names = df.columns

    def run(batches):
        c = codec(path)
        for batch in batches:
            for lo, hi in chunks(batch, text, 2_000_000):
                part = batch.slice(lo, hi - lo)
                found = c.encode([t or "" for t in part.column(text).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, _ids_column(found)],
                                                 names=[*names, ids])

    schema = StructType([*df.schema.fields, StructField(ids, ArrayType(IntegerType()))])
    return df.mapInArrow(run, schema)


def _encode_long(texts: DataFrame, path: str, leaf: int, window: int) -> DataFrame:
    """(key, ids) of texts (key, text) by tree concatenation."""
    n = F.ceil(F.length("text") / F.lit(leaf)).cast("int")
    # every leaf is a row of its own, dealt out evenly before it is encoded
    leaves = (texts.select("key", "text", F.explode(F.sequence(F.lit(0), n - 1)).alias("at"))
              .select("key", "at", F.substring("text", F.col("at") * leaf + 1, F.lit(leaf)).alias("text"))
              .repartition("key", "at"))
    level = cut(_with_ids(leaves, "text", path, "ids"))
    most = (level.agg(F.max("at")).first()[0] or 0) + 1

    def pair(batches):
        c = codec(path)
        for batch in batches:
            for r in batch.to_pylist():
                text, ids = r["text"], np.array(r["ids"], dtype=np.int32)
                if r["text2"] is not None:
                    ids = join(c, text, ids, r["text2"], np.array(r["ids2"], dtype=np.int32), window)
                    text += r["text2"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["key"]]), pa.array([r["at"] // 2], pa.int32()), pa.array([text]),
                     _ids_column([ids])], names=["key", "at", "text", "ids"])

    while most > 1:
        left = level.filter("at % 2 = 0")
        right = level.filter("at % 2 = 1").select(
            "key", (F.col("at") - 1).alias("at"), F.col("text").alias("text2"),
            F.col("ids").alias("ids2"))
        level = cut(left.join(right, ["key", "at"], "left").mapInArrow(
            pair, "key string, at int, text string, ids array<int>"))
        most = (most + 1) // 2
    return level.select("key", "ids")


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids",
           leaf: int = LEAF, window: int = WINDOW) -> DataFrame:
    """``df`` with the ids of each whole ``text`` in the column ``ids``, new
    or in place of one of that name.

    Long texts are told apart by their SHA-256, so copies are encoded once.
    """
    df = df.drop(ids)
    long = F.coalesce(F.length(text) > leaf, F.lit(False))
    short = _with_ids(df.filter(~long), text, path, ids)
    key = F.sha2(F.col(text), 256)
    distinct = (df.filter(long).select(key.alias("key"), F.col(text).alias("text"))
                .groupBy("key").agg(F.first("text").alias("text")))
    done = _encode_long(distinct, path, leaf, window).select(
        F.col("key").alias("_bpe_key"), F.col("ids").alias(ids))
    rest = df.filter(long).withColumn("_bpe_text_key", key)
    rest = rest.join(done, F.col("_bpe_text_key") == F.col("_bpe_key"))
    return short.unionByName(rest.drop("_bpe_key", "_bpe_text_key"))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids decode to in the column ``out``, new
    or in place of one of that name."""
    df = df.drop(out)
    names = df.columns

    def run(batches):
        c = codec(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                col = part.column(ids)
                flat = np.asarray(col.flatten()).tolist()
                ends = np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(col), 0)).tolist()
                texts = [c.decode(flat[a:b]) for a, b in zip([0, *ends], ends)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 names=[*names, out])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(out, StringType())]))
