"""Near-duplicate documents by circulant MinHash.

A document's set is its distinct shingles of ``WIDTH`` words. Two
permutations make all signature coordinates: the first scatters the
shingles once, the second, shifted circularly by k, gives coordinate k as
the smallest value over the set. Coordinates are banded; documents that
agree on a band are candidates; every link is confirmed on the full sets.

Documents with equal sets are one class, represented by its smallest id, so
copies never meet each other. Within a bucket of a band, members meet hubs
as :mod:`buckets` has it: a large group of near copies costs a link each,
and no pair of a bucket that could join two components is left out. Before any
set moves, pairs are ruled out whose signatures agree on too few coordinates.

The number of bands and of coordinates to agree on follow from the threshold:
a pair at it is missed by either with probability ``MISS`` at most.

Defined cases: words are split at white space, A-Z is lower-cased; a text
with fewer words has one shingle, one without words (or NULL) none, and is
linked with nothing; rows that repeat an id are one document, linked if any
of its texts is; a NULL id has a NULL component and is kept; an empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import chunks, cut, text_bytes
from .buckets import bucket_components, with_component

WIDTH = 5
ROWS = 5
MISS = 1e-6
COORDINATES = 256                 # of a signature, at least: the first ones make the bands
_U = np.uint64
# Fixed odd multipliers of the hashes and permutations.
_BASE = 0x9E3779B97F4A7C15
_FOLD = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
         0xE7037ED1A0B428DB)
_BLOCK = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, _U(base), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the rolling base and of its inverse, as many as were needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        return self.up, self.down


_powers_kept = _Powers()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(_FOLD[0])
    x = (x ^ (x >> _U(29))) * _U(_FOLD[1])
    return x ^ (x >> _U(32))


def word_hashes(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the text that it is in, of texts back to back."""
    word = ~_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[off] = True
    start = np.flatnonzero(word & (edge[:-1] | ~np.concatenate([[False], word[:-1]])))
    end = np.flatnonzero(word & (edge[1:] | ~np.concatenate([word[1:], [False]]))) + 1
    out = np.empty(len(start), np.uint64)
    lo = 0
    while lo < len(start):  # a block of words at a time; a longer word is one of its own
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + _BLOCK, side="right")))
        a = start[lo]
        part = _LOWER[raw[a:end[hi - 1]]] + _U(1)
        up, down = _powers_kept.get(max(len(part), _BLOCK))
        sums = np.concatenate([[_U(0)], np.cumsum(part * up[:len(part)])])
        s, e = start[lo:hi] - a, end[lo:hi] - a
        out[lo:hi] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        lo = hi
    return _mix(out), np.searchsorted(off, start, side="right") - 1


def shingle_sets(raw: np.ndarray, off: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    with np.errstate(over="ignore"):
        words, doc = word_hashes(raw, off)
        n = len(off) - 1
        count = np.bincount(doc, minlength=n)
        first = np.concatenate([[0], np.cumsum(count)])
        full = max(len(words) - width + 1, 0)
        h = np.zeros(full, np.uint64)
        for k in range(width):
            h = (h + words[k:k + full]) * _U(_FOLD[k % len(_FOLD)])
        h = _mix(h)
        sets = []
        for i in range(n):
            a, m = first[i], count[i]
            if m >= width:
                sets.append(np.unique(h[a:a + m - width + 1]))
            elif m:
                v = _U(m)
                for k in range(m):
                    v = (v + words[a + k]) * _U(_FOLD[k % len(_FOLD)])
                sets.append(_mix(np.array([v ^ _U(_FOLD[4])])))
            else:
                sets.append(np.zeros(0, np.uint64))
    return sets


def _second(x: np.ndarray, out: np.ndarray, tmp: np.ndarray) -> np.ndarray:
    """The permutation of the 32-bit universe that is shifted (in place)."""
    np.right_shift(x, np.uint32(16), out=tmp)
    np.bitwise_xor(x, tmp, out=out)
    np.multiply(out, np.uint32(0x7FEB352D), out=out)
    np.right_shift(out, np.uint32(15), out=tmp)
    np.bitwise_xor(out, tmp, out=out)
    np.multiply(out, np.uint32(0x846CA68B), out=out)
    return out


def signatures(sets: list[np.ndarray], k: int) -> np.ndarray:
    """Coordinates 0..k-1 of each non-empty set, a row per set."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    with np.errstate(over="ignore"):
        x = (flat ^ (flat >> _U(32))).astype(np.uint32)
        x = (x ^ (x >> np.uint32(17))) * np.uint32(0xED5AD4BB)     # the first permutation
        x = (x ^ (x >> np.uint32(11))) * np.uint32(0xAC4C1B51)
        out = np.empty((len(sets), k), np.uint32)
        a, b, c = np.empty_like(x), np.empty_like(x), np.empty_like(x)
        for i in range(k):
            np.add(x, np.uint32(i), out=a)                          # the shift
            out[:, i] = np.minimum.reduceat(_second(a, b, c), starts)
    return out


def band_count(percent: int, rows: int = ROWS) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** rows))


def coordinates(bands: int, rows: int = ROWS) -> int:
    return max(COORDINATES, bands * rows)


def band_keys(sig: np.ndarray, bands: int, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key per band that also names the band."""
    with np.errstate(over="ignore"):
        s = sig.reshape(len(sig), bands, rows).astype(np.uint64)
        h = np.broadcast_to(np.arange(bands, dtype=np.uint64) + _U(1), s.shape[:2]).copy()
        for r in range(rows):
            h = _mix((h + s[:, :, r]) * _U(_BASE))
    return h.view(np.int64)


def least_agreement(percent: int, count: int) -> int:
    """Fewest of ``count`` coordinates on which sets at the threshold agree,
    but for a probability of ``MISS``."""
    p, below, k = percent / 100, 0.0, 0
    while True:
        below += math.comb(count, k) * p ** k * (1 - p) ** (count - k)
        if below > MISS:
            return k
        k += 1


def packed(sig: np.ndarray) -> np.ndarray:
    """Four bits of each coordinate, sixteen to a long; the rest are zero."""
    low = np.zeros((len(sig), -(-sig.shape[1] // 16) * 16), np.uint8)
    low[:, :sig.shape[1]] = sig & np.uint32(15)
    return (low[:, ::2] | low[:, 1::2] << np.uint8(4)).view(np.int64)


def may_be_linked(percent: int, count: int):
    """Whether signatures as :func:`packed` has them leave a link possible.
    Coordinates that differ may agree by chance in their four bits, which
    only makes more pairs possible."""
    most = count - least_agreement(percent, count)

    def differ(x, y):
        v = x.bitwiseXOR(y)
        v = v.bitwiseOR(F.shiftrightunsigned(v, 1))
        v = v.bitwiseOR(F.shiftrightunsigned(v, 2))
        return F.bit_count(v.bitwiseAND(F.lit(0x1111111111111111)))

    def may(x, y):
        return reduce(add, [differ(F.get(x, i), F.get(y, i)) for i in range(-(-count // 16))]) <= most
    return may


def _lists(rows: np.ndarray, mask: np.ndarray) -> pa.Array:
    """A list column; rows where ``mask`` is False are empty."""
    size = np.where(mask, rows.shape[1] if rows.ndim == 2 else 0, 0)
    off = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(rows.ravel()))


def signature_table(docs: DataFrame, bands: int, key: str = "doc_id", text: str = "text",
                    width: int = WIDTH) -> DataFrame:
    """(doc_id, n, f1, f2, keys, sig): set size, 128-bit digest of the set, band
    keys, and the signature in brief."""
    count = coordinates(bands)

    def run(batches):
        for batch in batches:
            for lo, hi in chunks(batch, text, 1_000_000):
                part = batch.slice(lo, hi - lo)
                raw, off = text_bytes(part.column(text))
                sets = shingle_sets(raw, off, width)
                n = np.array([len(s) for s in sets], np.int64)
                some = [s for s in sets if len(s)]
                sig = signatures(some, count) if some else np.zeros((0, count), np.uint32)
                d = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                f = np.frombuffer(b"".join(d), dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [part.column(key), pa.array(n), pa.array(f[:, 0].copy()),
                     pa.array(f[:, 1].copy()), _lists(band_keys(sig[:, :bands * ROWS], bands), n > 0), _lists(packed(sig), n > 0)],
                    names=["doc_id", "n", "f1", "f2", "keys", "sig"])

    return docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(
        run, "doc_id long, n long, f1 long, f2 long, keys array<long>, sig array<long>")


def _possible(x: np.ndarray, sigs: np.ndarray, most: int) -> np.ndarray:
    """Which rows of packed signatures differ from ``x`` in at most ``most`` coordinates."""
    v = sigs ^ x
    v |= v >> _U(1)
    v |= v >> _U(2)
    return np.bitwise_count(v & _U(0x1111111111111111)).sum(axis=1, dtype=np.int64) <= most


def _joining(rows: pa.Table, percent: int, most: int, width: int, reach: float) -> list[tuple[int, int]]:
    """Links between members of a cell, of those that it holds no more than
    connect them: a pair is left out that lies in one component by then, or
    whose smallest common bucket is another."""
    key, cross = rows.column("key")[0].as_py(), rows.column("i")[0].as_py() != rows.column("j")[0].as_py()
    block, out, rep, n = (rows.column(c).to_numpy() for c in ("block", "out", "rep", "n"))
    far = rows.column("far").to_numpy()
    root = np.unique(rows.column("comp").to_numpy(), return_inverse=True)[1]
    known, sigs = np.zeros(len(rep), bool), np.zeros((len(rep), width), np.uint64)
    for r, sig in enumerate(rows.column("sig").to_pylist()):
        if sig is not None:
            known[r], sigs[r] = True, np.array(sig, np.int64).view(np.uint64)
    keys = [np.array(k, np.int64) for k in rows.column("keys").to_pylist()]
    sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in rows.column("s").combine_chunks()]
    links = []
    for r in np.flatnonzero(out):
        # of two outsiders of a cell the earlier one meets the later one
        may = (root != root[r]) & (~out | (np.arange(len(rep)) > r))
        if cross:
            may &= block != block[r]
        may &= 100 * np.minimum(n, n[r]) >= percent * np.maximum(n, n[r])
        with np.errstate(invalid="ignore"):
            may &= ~(np.abs(far - far[r]) > reach)          # no distance (nan) rules nothing out
        others = np.flatnonzero(may)
        if known[r]:
            others = others[~known[others] | _possible(sigs[r], sigs[others], most)]
        for o in others:
            if root[o] == root[r]:
                continue
            both = len(np.intersect1d(sets[r], sets[o], assume_unique=True))
            if not both or 100 * both < percent * (len(sets[r]) + len(sets[o]) - both):
                continue
            if np.intersect1d(keys[r], keys[o], assume_unique=True)[0] == key:
                links.append((int(rep[r]), int(rep[o])))
                root[root == root[o]] = root[r]
    return links


def _solve(sets_of, percent: int, most: int, width: int):
    """Cells of :mod:`buckets` solved on full sets, each in a task that holds no more than one."""
    def run(batches, reach):
        held = []

        def solved():
            found = _joining(pa.Table.from_batches(held), percent, most, width, reach) if held else []
            held.clear()
            a, b = ([f[side] for f in found] for side in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        last = None
        for batch in batches:
            cell = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "i", "j")], axis=1)
            starts = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]).any(axis=1)])) if len(cell) else []
            for lo, hi in zip(starts, [*starts[1:], len(cell)]):
                if last is not None and tuple(cell[lo]) != last:
                    yield solved()
                last = tuple(cell[lo])
                held.append(batch.slice(lo, hi - lo))
        yield solved()

    def solve(cells, reps, reach):
        sets = sets_of(reps).select(F.col("id").alias("rep"), "s")
        rows = (cells.join(sets, "rep").select("key", "i", "j", "block", "out", "rep", "n", "comp", "far", "sig", "keys", "s")
                .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"))
        return cut(rows.mapInArrow(lambda batches: run(batches, reach), "a long, b long"))
    return solve


def _prepare(docs: DataFrame, key: str, text: str, percent: int, width: int):
    """The full sets of the documents that share a bucket, made once, and the
    comparison of pairs of them by Jaccard distance."""
    def to_sets(batches):
        for batch in batches:
            for lo, hi in chunks(batch, text, 1_000_000):
                part = batch.slice(lo, hi - lo)
                sets = shingle_sets(*text_bytes(part.column(text)), width)
                yield pa.RecordBatch.from_arrays(
                    [part.column(key), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["id", "s"])

    def confirm(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                x, y = part.column("sa"), part.column("sb")
                far, ok = np.ones(part.num_rows), np.zeros(part.num_rows, bool)
                for i in range(part.num_rows):
                    p = np.frombuffer(x[i].as_buffer(), np.uint64)
                    q = np.frombuffer(y[i].as_buffer(), np.uint64)
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    either = len(p) + len(q) - both
                    ok[i] = both > 0 and 100 * both >= percent * either
                    far[i] = 1 - both / max(either, 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b"), pa.array(far), pa.array(ok)],
                    names=["a", "b", "far", "linked"])

    def sets_of(reps):
        texts = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias(text))
        ids = reps.select(F.col("rep").alias("_id"))
        return texts.join(ids, F.col(key) == F.col("_id"), "left_semi").mapInArrow(to_sets, "id long, s binary")

    def prepare(reps):
        sets = cut(sets_of(reps))

        def verify(pairs):
            left = sets.select(F.col("id").alias("a"), F.col("s").alias("sa"))
            right = sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
            both = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
            # of an id with several texts any may be linked; it has no one distance
            return cut(both.mapInArrow(confirm, "a long, b long, far double, linked boolean")
                       .groupBy("a", "b").agg(F.when(F.count(F.lit(1)) == 1, F.min("far")).alias("far"),
                                              F.max("linked").alias("linked")))
        return verify
    return prepare, sets_of


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    percent: int = 85, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``:
    linked are sets with 100 * intersection >= ``percent`` * union."""
    bands = band_count(percent)
    sig = cut(signature_table(docs, bands, key, text, width))
    classes = (sig.filter("n > 0 and doc_id is not null").groupBy("f1", "f2")
               .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"),
                    F.first("keys").alias("keys"), F.first("sig").alias("sig")))
    classes = cut(classes)

    members = classes.select("rep", "n", F.explode("keys").alias("key"))
    # of an id with several texts any may be linked: it has no one signature
    one = classes.groupBy("rep").agg(F.when(F.count(F.lit(1)) == 1, F.first("sig")).alias("sig"))
    count = coordinates(bands)
    may = may_be_linked(percent, count)
    prepare, sets_of = _prepare(docs, key, text, percent, width)
    solve = _solve(sets_of, percent, count - least_agreement(percent, count), -(-count // 16))
    comps = bucket_components(members, prepare, percent, one,
                              lambda x, y: F.coalesce(may(x, y), F.lit(True)), solve)
    reps = classes.select(F.col("f1").alias("_f1"), F.col("f2").alias("_f2"), "rep")
    found = sig.select("doc_id", F.col("n").alias("n_shingles"), "f1", "f2").join(
        reps, (F.col("f1") == F.col("_f1")) & (F.col("f2") == F.col("_f2"))
        & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), "left")
    found = with_component(found.withColumn("rep", F.coalesce("rep", "doc_id")),
                           "rep", "component_id", comps)
    return found.select("doc_id", "n_shingles", "component_id",
                        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def distinct_documents(docs: DataFrame, key: str = "doc_id", text: str = "text",
                       percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each group of near duplicates: that of the
    smallest id, and of rows that share it that with the smallest hash of its
    text. Rows without an id all stay."""
    kept = near_duplicates(docs, key, text, percent).filter("kept and doc_id is not null")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).cast("long").alias("doc_id"),
                       F.xxhash64(text).alias("h"))
    named = rows.join(kept.select("doc_id").distinct(), "doc_id", "left_semi")
    nth = Window.partitionBy("doc_id").orderBy("h", F.col("row")[text])
    one = named.withColumn("nth", F.row_number().over(nth)).filter("nth = 1")
    return one.select("row.*").unionByName(docs.filter(F.col(key).isNull()))
