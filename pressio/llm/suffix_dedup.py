"""Removal of repeated byte strings by prefix-free parsing.

Removed is every byte covered by a string of ``length`` bytes that also
starts earlier in the corpus. A rolling hash over ``GRAM`` bytes triggers a
phrase boundary where it is smallest within a window of ``length`` bytes, so
every window has a trigger, equal windows have the same one at the same
place, and the windows of one trigger are neighbours. The bytes that the
windows of one trigger span are a phrase; phrases overlap by length - 1 bytes,
so each window lies in exactly one and none runs out of its phrase.

* Dictionary: phrases are sorted by (trigger hash, content digest, place).
  The first of equal phrases enters the dictionary; the parse of all others
  points at it, and their windows are all repeats. Highly repetitive text
  ends here.
* Two windows in different phrases can only be equal if their phrases share
  the trigger. Only dictionary phrases that share it with another are taken
  apart into their suffixes: the starts of their windows, cut at ``length``
  bytes, beyond which order does not matter. Sorted together with the place,
  equal suffixes are neighbours, as in a suffix array, and all but the first
  in corpus order are repeats.

Both sorts are Spark's, within partitions dealt out by trigger, and are read as streams:
no group is held in memory. Equal phrases that meet within one chunk of
texts are merged before the shuffle, so a passage that very many documents
share costs a row per chunk.

Defined cases: a NULL text is empty; a text shorter than ``length`` keeps
all bytes; matches never cross documents; rows that share an id are
documents of their own, in the order of a hash of their text, and wholly
equal rows are one, with one result each; a NULL id comes back whole and is no
earlier place of anything; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import chunks, text_bytes

LENGTH = 100
GRAM = 32
CHUNK = 8_000_000
# A longer text is parsed in pieces of this many window starts; their
# places must fit the low bits of the sliding minimum.
PIECE = 1 << 19
_BITS = 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_KEYS = ["doc_id", "tag"]
_PARSE = "trigger long, digest long, doc_id long, packed long"
# A phrase's tag, start, whether merged, and windows, in one long that sorts
# by tag and start: the parse is what is shuffled most.
_TAG_BITS, _START_BITS, _N_BITS = 20, 31, 11
_RUNS = "doc_id long, tag int, start int, n int, trigger long, open boolean"


def _rolling(raw: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each place; gram is a power of two."""
    h, k, p = raw.astype(np.uint64) + _U(1), 1, _BASE
    with np.errstate(over="ignore"):
        while k < gram:
            h = h[:-k] * _U(p) + h[k:]
            p, k = p * p & 0xFFFFFFFFFFFFFFFF, 2 * k
        h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
        return h ^ (h >> _U(32))


def _sliding_min(v: np.ndarray, n: int) -> np.ndarray:
    k = 1
    while 2 * k <= n:
        v = np.minimum(v[:-k], v[k:])
        k *= 2
    return np.minimum(v[:len(v) - (n - k)], v[n - k:]) if k < n else v


def parse(raw: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(trigger hash, first window start, windows) of the phrases of a text."""
    out = []
    for at in range(0, max(len(raw) - length + 1, 0), PIECE):
        part = raw[at:at + PIECE + length - 1]
        h = _rolling(part, gram)
        place = np.arange(len(h), dtype=np.uint64)
        low = _sliding_min((h >> _U(_BITS) << _U(_BITS)) | place, length - gram + 1)
        pos = (low & _U((1 << _BITS) - 1)).astype(np.int64)
        s = np.flatnonzero(np.concatenate([[True], pos[1:] != pos[:-1]]))
        out.append((h[pos[s]].view(np.int64), at + s, np.diff(np.append(s, len(pos)))))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*out))


def _digests(blob: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    f = xxhash.xxh3_64_intdigest
    found = [f(blob[a:a + n]) for a, n in zip(starts.tolist(), sizes.tolist())]
    return np.array(found, dtype=np.uint64).view(np.int64)


def _columns(*cols) -> list[pa.Array]:
    return [pa.array(c) for c in cols]


def _merge_equal(trigger, digest, doc, tag, start, n):
    """Order by (trigger, digest, place); all but the first of equals are
    marked as merged and dealt out by their place instead."""
    o = np.lexsort((start, tag, doc, digest, trigger))
    trigger, digest, doc, tag, start, n = (c[o] for c in (trigger, digest, doc, tag, start, n))
    same, again = np.zeros(len(o), bool), np.zeros(len(o), bool)
    if len(o):
        same[1:] = (trigger[1:] == trigger[:-1]) & (digest[1:] == digest[:-1])
        again[1:] = same[1:] & (doc[1:] == doc[:-1]) & (tag[1:] == tag[:-1]) & (start[1:] == start[:-1])
        trigger, digest, doc, tag, start, n, same = (
            c[~again] for c in (trigger, digest, doc, tag, start, n, same))
    with np.errstate(over="ignore"):
        spread = (doc.view(np.uint64) * _U(_BASE) + start.astype(np.uint64)).view(np.int64)
    packed = (((tag.astype(np.int64) << _START_BITS | start) << 1 | same) << _N_BITS) | n
    return np.where(same, spread, trigger), digest, doc, packed


def _unpacked(packed: np.ndarray):
    """(tag, start, merged, n)."""
    rest = packed >> _N_BITS
    return (rest >> (_START_BITS + 1), rest >> 1 & ((1 << _START_BITS) - 1), (rest & 1).astype(bool),
            packed & ((1 << _N_BITS) - 1))


def _parse_table(texts: DataFrame, length: int) -> DataFrame:
    """The parse: one row per phrase."""
    names = [x.split()[0] for x in _PARSE.split(", ")]

    def run(batches):
        for batch in batches:
            for lo, hi in chunks(batch, "text", CHUNK):
                part = batch.slice(lo, hi - lo)
                raw, off = text_bytes(part.column("text"))
                ids = np.asarray(part.column("doc_id"))
                tags = np.asarray(part.column("tag"))
                rows = []
                for i in range(hi - lo):
                    text = raw[off[i]:off[i + 1]]
                    t, s, n = parse(text, length)
                    if len(t):
                        d = _digests(text.tobytes(), s, n + length - 1)
                        rows.append((t, d, np.full(len(t), ids[i]), np.full(len(t), tags[i]), s, n))
                if rows:
                    cols = _merge_equal(*(np.concatenate(c) for c in zip(*rows)))
                    for a in range(0, len(cols[0]), 100_000):
                        yield pa.RecordBatch.from_arrays(
                            _columns(*(c[a:a + 100_000] for c in cols)), names=names)

    return texts.mapInArrow(run, _PARSE)


def _dictionary(parsed: DataFrame) -> DataFrame:
    """Sorted phrases to (place, windows, trigger, open): closed rows are
    repeats, open ones dictionary phrases that share their trigger with another.
    Other dictionary phrases are dropped: nothing in them occurs twice."""
    names = [x.split()[0] for x in _RUNS.split(", ")]

    def run(batches):
        # of the trigger read last: trigger, digest, dictionary phrases so far,
        # and the first of them while it is the only one
        t0 = d0 = alone = last = None
        seen = 0
        for batch in batches:
            t, d, doc, packed = (np.asarray(c) for c in batch.columns)
            tag, start, merged, n = _unpacked(packed)
            place = [doc, tag, start, n]
            closed = int(merged.sum())
            rows = [(*(c[merged] for c in place), np.zeros(closed, np.int64), np.zeros(closed, bool))]
            t, d, packed, place = t[~merged], d[~merged], packed[~merged], [c[~merged] for c in place]
            if len(t):  # the same place again, from a row that repeats
                mark = np.stack([t, d, place[0], packed])
                again = np.concatenate([[last is not None and (mark[:, 0] == last).all()],
                                        (mark[:, 1:] == mark[:, :-1]).all(axis=0)])
                last = mark[:, -1]
                t, d, place = t[~again], d[~again], [c[~again] for c in place]
            if len(t):
                new_t = np.concatenate([[t0 is None or t[0] != t0], t[1:] != t[:-1]])
                new_d = np.concatenate([[d0 is None or d[0] != d0], d[1:] != d[:-1]]) | new_t
                group = np.cumsum(new_t)       # 0: the trigger read last goes on
                count = np.bincount(group, weights=new_d).astype(np.int64)
                goes_on = not new_t[0]
                if goes_on:
                    count[0] += seen
                    if alone is not None and count[0] > 1:
                        rows.append((*(np.array([v]) for v in alone), t[:1], np.ones(1, bool)))
                        alone = None
                shared = new_d & (count[group] > 1)
                take = shared | ~new_d
                rows.append((*(c[take] for c in place), np.where(shared, t, 0)[take], shared[take]))
                t0, d0, seen = t[-1], d[-1], count[-1]
                if seen > 1:
                    alone = None
                elif not (goes_on and group[-1] == 0):
                    i = int(np.flatnonzero(group == group[-1])[0])
                    alone = tuple(c[i] for c in place)
            doc, tag, start, n, trigger, is_open = (np.concatenate(c) for c in zip(*rows))
            if len(doc):
                yield pa.RecordBatch.from_arrays(_columns(
                    doc.astype(np.int64), tag.astype(np.int32), start.astype(np.int32),
                    n.astype(np.int32), trigger, is_open.astype(bool)), names=names)

    dealt = parsed.repartition("trigger").sortWithinPartitions(
        "trigger", "digest", "doc_id", "packed")
    return dealt.mapInArrow(run, _RUNS)


def _suffix_repeats(phrases: DataFrame, length: int) -> DataFrame:
    """(doc_id, tag, start, n = 1) of windows of open phrases that are not the first."""
    def suffixes(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                raw = part.column("bytes").to_pylist()
                n = np.array([len(b) - length + 1 for b in raw], np.int64)
                d = np.frombuffer(b"".join(xxhash.xxh3_128_digest(b[i:i + length])
                                           for b in raw for i in range(len(b) - length + 1)),
                                  dtype=np.int64).reshape(-1, 2)
                first = np.repeat(np.cumsum(n) - n, n)
                start = np.repeat(np.asarray(part.column("start")), n) + np.arange(len(d)) - first
                yield pa.RecordBatch.from_arrays(
                    _columns(d[:, 0].copy(), d[:, 1].copy(),
                             np.repeat(np.asarray(part.column("doc_id")), n),
                             np.repeat(np.asarray(part.column("tag")), n), start.astype(np.int32)),
                    names=["w1", "w2", "doc_id", "tag", "start"])

    def repeats(batches):
        before = None
        for batch in batches:
            w1, w2 = np.asarray(batch.column("w1")), np.asarray(batch.column("w2"))
            if not len(w1):
                continue
            mark = np.stack([w1, w2, *(np.asarray(batch.column(c), dtype=np.int64)
                                       for c in ("doc_id", "tag", "start"))])
            equal = np.empty(mark.shape, bool)
            equal[:, 0] = before is not None and mark[:, 0] == before
            equal[:, 1:] = mark[:, 1:] == mark[:, :-1]
            before = mark[:, -1]
            # equal suffixes, but not the same place from a row that repeats
            same = equal[:2].all(axis=0) & ~equal.all(axis=0)
            kept = batch.select(["doc_id", "tag", "start"]).filter(pa.array(same))
            if kept.num_rows:
                yield kept

    sorted_ = (phrases.repartition("trigger")
               .mapInArrow(suffixes, "w1 long, w2 long, doc_id long, tag int, start int")
               .sortWithinPartitions("w1", "w2", *_KEYS, "start"))
    return sorted_.mapInArrow(repeats, "doc_id long, tag int, start int")


def _cover(size: int, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by [start, end)."""
    delta = np.zeros(size + 1, np.int64)
    np.add.at(delta, starts, 1)
    np.add.at(delta, ends, -1)
    hit = np.concatenate([[False], np.cumsum(delta)[:-1] > 0, [False]])
    edge = np.flatnonzero(hit[1:] != hit[:-1])
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   length: int = LENGTH) -> DataFrame:
    """(doc_id, text, spans): each row of ``docs`` with the maximal runs of
    bytes to remove, as [first, end) offsets into its UTF-8 text."""
    every = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    if not GRAM <= length < 1 << _N_BITS:
        raise ValueError(f"length must be from {GRAM} to {(1 << _N_BITS) - 1}")
    tag = F.xxhash64("text").bitwiseAND(F.lit((1 << _TAG_BITS) - 1)).cast("int")
    texts = every.filter("doc_id is not null").withColumn("tag", tag)
    runs = _dictionary(_parse_table(texts, length))
    per_doc = runs.groupBy(*_KEYS).agg(F.collect_list(F.struct("start", "n", "trigger", "open")).alias("runs"))
    met = texts.join(per_doc, _KEYS, "left")

    def open_phrases(batches):
        """Phrases to be taken apart, with their bytes and trigger."""
        for batch in batches:
            for i in range(batch.num_rows):
                runs_ = batch.column("runs")[i]
                if not runs_.is_valid:
                    continue
                v = runs_.values
                at = np.asarray(v.field("open"))
                if not at.any():
                    continue
                start, n = np.asarray(v.field("start"))[at], np.asarray(v.field("n"))[at]
                blob = batch.column("text")[i].as_py().encode()
                parts = [blob[a:a + b + length - 1] for a, b in zip(start.tolist(), n.tolist())]
                k = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.asarray(v.field("trigger"))[at]), pa.array(parts, pa.binary()),
                     pa.array(np.full(k, batch.column("doc_id")[i].as_py())),
                     pa.array(np.full(k, batch.column("tag")[i].as_py(), np.int32)),
                     pa.array(start.astype(np.int32))],
                    names=["trigger", "bytes", "doc_id", "tag", "start"])

    phrases = met.select(*_KEYS, "text", "runs").mapInArrow(
        open_phrases, "trigger long, bytes binary, doc_id long, tag int, start int")
    windows = (_suffix_repeats(phrases, length).groupBy(*_KEYS)
               .agg(F.collect_list("start").alias("windows")))
    both = met.join(windows, _KEYS, "left")

    def spans(batches):
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                r, w = batch.column("runs")[i], batch.column("windows")[i]
                size = len(batch.column("text")[i].as_buffer() or b"")
                s, e = [], []
                if r.is_valid:
                    v = r.values
                    shut = ~np.asarray(v.field("open"))
                    a = np.asarray(v.field("start"))[shut].astype(np.int64)
                    s.append(a)
                    e.append(a + np.asarray(v.field("n"))[shut] + length - 1)
                if w.is_valid:
                    a = np.asarray(w.values).astype(np.int64)
                    s.append(a)
                    e.append(a + length)
                out.append([{"first": x, "end": y} for x, y in _cover(
                    size, np.concatenate(s), np.concatenate(e))] if s else [])
            kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(out, kind)],
                names=["doc_id", "text", "spans"])

    schema = "doc_id long, text string, spans array<struct<first:int,end:int>>"
    found = both.select(*_KEYS, "text", "runs", "windows").mapInArrow(spans, schema)
    whole = every.filter("doc_id is null").withColumn(
        "spans", F.array().cast("array<struct<first:int,end:int>>"))
    return found.unionByName(whole)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): the bytes that remain of
    each text. They need not be valid UTF-8: a span may begin inside a character."""
    def run(batches):
        for batch in batches:
            blobs, removed, count, sizes = [], [], [], []
            for i in range(batch.num_rows):
                blob = batch.column("text")[i].as_py().encode()
                runs = batch.column("spans")[i].as_py()
                at, kept = 0, []
                for r in runs:
                    kept.append(blob[at:r["first"]])
                    at = r["end"]
                kept.append(blob[at:])
                blobs.append(b"".join(kept))
                sizes.append(len(blob))
                removed.append(len(blob) - len(blobs[-1]))
                count.append(len(runs))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(count, pa.int64()), pa.array(blobs, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return repeated_spans(docs, key, text, length).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
