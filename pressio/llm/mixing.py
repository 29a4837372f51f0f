"""Mixing sources to target weights, in fixed-length blocks of words.

The texts of a source, in a pseudorandom order of its documents, form one
stream of words cut into blocks of ``block`` words. A mix is a sequence of
slots in shards of ``shard`` slots. Every shard draws how many slots each
source gets from a multinomial, conditioned on the sources' totals (a
multivariate hypergeometric, drawn down a binary tree of shard ranges, so any
shard computes its own counts and where they start in each source). Slot t
of a source takes block permutation(t): a keyed permutation of the
source's block indices, a new one for every pass over it. Slots and blocks
are then joined by (source, block index).

Only per-source totals reach the driver.

Defined cases: a NULL text has size 0; a document of size 0 lies in no
block and is never taken; a NULL source is a source of its own, last in
order; rows that repeat (same doc_id, or wholly equal) are documents of
their own; an empty table gives no rows. Columns beyond the named ones are
ignored (or kept by :func:`mix_texts`), whatever they are called.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import as_col
from ._common import cut, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
BLOCK = 64
SHARD = 1024
BUCKETS = 1024
SEED = 20_240_607
# Above this many slots a range is drawn by this module, below by numpy's
# generator, which takes no more than a thousand million.
DRAWN_UP_TO = 500_000_000
# Constants of the ratio of uniforms: 2 sqrt(2 / e) and 3 - 2 sqrt(3 / e).
HAT = 1.7155277699214135, 0.8989161620588988


def source_targets(sizes: DataFrame, share: float = SHARE, cap: float = CAP,
                   weights=WEIGHTS) -> DataFrame:
    """One row per source: source, rank (0-based, by code point, NULL last),
    source_size, target.

    Targets share ``share`` times all sizes by weight, none above ``cap``
    times its source's size: with sources in the order of cap / weight, the
    first k are at their caps and the rest share what remains; k is the
    first for which that share exceeds no cap. One row per source is in one
    task here, however many documents there are.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    ws = F.array(*[F.lit(float(w)) for w in weights])
    per = (per.withColumn("rank", F.row_number().over(order) - 1)
           .withColumn("w", F.element_at(ws, (F.col("rank") % len(weights) + 1).cast("int")))
           .withColumn("top", F.col("source_size") * F.lit(float(cap)))
           .withColumn("r", F.col("top") / F.col("w")))
    every = Window.partitionBy(F.lit(0))
    by_r = every.orderBy("r", "rank")
    before = by_r.rowsBetween(Window.unboundedPreceding, -1)
    after = by_r.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    per = (per.withColumn("total", F.sum("source_size").over(every) * F.lit(float(share)))
           .withColumn("level", (F.col("total") - F.coalesce(F.sum("top").over(before), F.lit(0.0)))
                       / F.sum("w").over(after)))
    fits = F.min(F.when(F.col("level") <= F.col("r"), F.struct("r", "rank", "level"))).over(every)
    return per.withColumn("fit", fits).select(
        "source", "rank", "source_size",
        F.least(F.col("top"), F.coalesce(F.col("fit.level") * F.col("w"), F.col("top")))
        .alias("target"))


def _positions(docs: DataFrame, targets: DataFrame, salt) -> DataFrame:
    """Documents with _rank, _target, _source_size and _start: where a
    document begins in its source's stream.

    Prefix sums in two steps: documents are spread over ``BUCKETS`` buckets
    per source by a hash of doc_id, buckets are summed in order, and only a
    bucket's own documents are summed in one task.
    """
    d = docs.join(targets.select(F.col("source").alias("_src"), F.col("rank").alias("_rank"),
                                 F.col("source_size").alias("_source_size"),
                                 F.col("target").alias("_target")),
                  F.col("source").eqNullSafe(F.col("_src"))).drop("_src")
    d = d.withColumn("_bucket", F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(BUCKETS)))
    b = d.groupBy("_rank", "_bucket").agg(F.sum("size").alias("_n"))
    w = Window.partitionBy("_rank").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    b = b.select("_rank", "_bucket", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_base"))
    w = (Window.partitionBy("_rank", "_bucket").orderBy(F.xxhash64(F.lit(SEED + 1), "doc_id"),
                                                        "doc_id", "size", *salt)
         .rowsBetween(Window.unboundedPreceding, -1))
    return (d.join(b, ["_rank", "_bucket"])
            .withColumn("_start", F.col("_base") + F.coalesce(F.sum("size").over(w), F.lit(0)))
            .drop("_base", "_bucket"))


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed pseudorandom permutation of 0..n-1 applied to ``index``: a
    four-round Feistel network on the next even power of two, walked until
    the value falls below n."""
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    h = np.uint64(half)
    out = index.astype(np.uint64)
    todo = np.ones(len(out), bool)
    with np.errstate(over="ignore"):
        while todo.any():
            x = out[todo]
            a, b = x >> h, x & low
            for r in range(4):
                k = np.uint64((key * 4 + r + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
                a, b = b, a ^ (_mix64(b + k) & low)
            out[todo] = (a << h) | b
            todo = out >= np.uint64(n)
    return out.astype(np.int64)


def _log_factorials(n: int, d: int) -> float:
    """log (n + d)! - log n! without the part d log(n + 1)."""
    z = n + 1
    if min(z, z + d) < 10_000:
        return math.lgamma(z + d) - math.lgamma(z) - d * math.log(z)
    return (z + d - 0.5) * math.log1p(d / z) - d + (1 / (z + d) - 1 / z) / 12


def _hypergeometric(rng, good: int, bad: int, sample: int) -> int:
    """How many of ``sample`` draws without replacement are good, for numbers
    of any size: rejection from a ratio of uniforms (Stadlober's HRUA), with
    probabilities relative to the mode, where large terms cancel."""
    n = good + bad
    low, high = max(0, sample - bad), min(good, sample)
    if low == high:
        return low
    mode = min(max((sample + 1) * (good + 1) // (n + 2), low), high)
    at = (mode, good - mode, sample - mode, bad - sample + mode)
    sign = (1, -1, -1, 1)
    # the sum of d log(n + 1) over the four: nearly nothing at the mode
    slope = sum(s * math.log(x + 1) for s, x in zip(sign, at))
    mean = sample * good / n
    spread = math.sqrt((n - sample) * (sample / n) * (good / n) * (bad / max(n - 1, 1)) + 0.5)
    width = HAT[0] * spread + HAT[1]
    while True:
        u, v = 1 - rng.random(), rng.random()
        x = math.floor(mean + 0.5 + width * (v - 0.5) / u)
        if low <= x <= high:
            d = x - mode
            if 2 * math.log(u) <= -d * slope - sum(_log_factorials(i, s * d) for s, i in zip(sign, at)):
                return x


def _drawn(rng, q: np.ndarray, left: int) -> np.ndarray:
    """Counts per source of ``left`` slots drawn without replacement from q."""
    n = int(q.sum())
    if n <= DRAWN_UP_TO:
        return rng.multivariate_hypergeometric(q, left, method="marginals")
    out = np.zeros(len(q), np.int64)
    for i, good in enumerate(map(int, q)):
        n -= good
        out[i] = _hypergeometric(rng, good, n, left)
        left -= int(out[i])
    return out


def shard_counts(quotas: list[int], lo: int, hi: int, shard: int = SHARD, seed: int = SEED):
    """(shard, slots per source, first slot per source) for shards lo..hi-1."""
    total = sum(quotas)
    out = []

    def walk(a: int, b: int, q: np.ndarray, start: np.ndarray) -> None:
        if b <= lo or a >= hi:
            return
        if b - a == 1:
            out.append((a, q, start))
            return
        m = (a + b) // 2
        c = _drawn(np.random.default_rng((seed, a, b)), q, (m - a) * shard)
        walk(a, m, c, start)
        walk(m, b, q - c, start + c)

    n_shards = math.ceil(total / shard)
    if n_shards:
        walk(0, n_shards, np.array(quotas, dtype=np.int64), np.zeros(len(quotas), np.int64))
    return out


def _slots(spark, quotas: list[int], blocks: list[int], shard: int, seed: int) -> DataFrame:
    """(shard, slot, rank, epoch, block) of every slot of the mix."""
    n_shards = math.ceil(sum(quotas) / shard)

    def draw(batches):
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for i in range(0, len(ids), 64):
                part = ids[i:i + 64]
                for s, q, start in shard_counts(quotas, int(part[0]), int(part[-1]) + 1, shard, seed):
                    ranks = np.repeat(np.arange(len(q)), q)
                    t = np.concatenate([np.arange(a, a + n) for a, n in zip(start, q)])
                    n = np.array(blocks, dtype=np.int64)[ranks]
                    epoch = t // np.maximum(n, 1)
                    block = np.empty(len(t), np.int64)
                    for r in np.flatnonzero(q):
                        for e in np.unique(epoch[ranks == r]):
                            at = (ranks == r) & (epoch == e)
                            block[at] = permute(t[at] - e * blocks[r], blocks[r],
                                                seed + 1_000_003 * int(r) + int(e))
                    order = np.random.default_rng((seed, s)).permutation(len(t))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(t), s, np.int64)),
                         pa.array(s * shard + np.argsort(order)), pa.array(ranks.astype(np.int32)),
                         pa.array(epoch), pa.array(block)],
                        names=["shard", "slot", "_rank", "epoch", "block"])

    parts = max(1, min(n_shards // 64 + 1, 10_000))
    return spark.range(0, n_shards, 1, parts).mapInArrow(
        draw, "shard long, slot long, _rank int, epoch long, block long")


def _quota(size: int, target: float, block: int, cap: float = CAP) -> tuple[int, int]:
    """(blocks, slots) of a source: as many slots as its blocks' mean length
    asks for (the last block is shorter), and no more than the cap allows."""
    blocks = math.ceil(size / block)
    return blocks, min(math.floor(target * blocks / size + 0.5), int(cap * blocks)) if size else 0


def _pieces(pos: DataFrame, block: int) -> DataFrame:
    """The blocks a document lies in: (_rank, block, _start, piece_first, piece_words)."""
    end = F.col("_start") + F.col("size")
    p = (pos.filter("size > 0")
         .select("_rank", "_start", "doc_id", end.alias("_end"),
                 F.explode(F.sequence(F.floor(F.col("_start") / block),
                                      F.floor((end - 1) / block))).alias("block")))
    first = F.greatest(F.col("_start"), F.col("block") * block)
    last = F.least(F.col("_end"), (F.col("block") + 1) * block)
    return p.select("_rank", "block", "_start", "doc_id",
                    (first - F.col("_start")).alias("piece_first"),
                    (last - first).alias("piece_words"))


def mix(docs: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED,
        share: float = SHARE, cap: float = CAP, weights=WEIGHTS, salt=()):
    """(positions, pieces, slots): every document with its place in its
    source's stream; the blocks each document lies in; and the mix itself, a
    row per slot with the block it takes. Join pieces and slots on (_rank,
    block) for the content of the mix.

    ``docs`` has doc_id, source and size. (_rank, _start) names a document
    of size over 0. ``salt`` are more columns that tell equal ids apart.
    """
    targets = cut(source_targets(docs, share, cap, weights))
    quota = [_quota(r["source_size"], r["target"], block, cap)
             for r in targets.orderBy("rank").select("source_size", "target").collect()]
    pos = cut(_positions(docs, targets, salt))
    slots = _slots(docs.sparkSession, [q for _, q in quota], [n for n, _ in quota], shard, seed)
    return pos, _pieces(pos, block), slots


def taken(docs: DataFrame, block: int = BLOCK, **kw) -> DataFrame:
    """Documents with source_size, target and taken words (repeats counted).

    What each block is drawn is counted before it meets the pieces.
    """
    sized = cut(docs)
    pos, pieces, slots = mix(sized, block, **kw)
    times = slots.groupBy("_rank", "block").agg(F.count(F.lit(1)).alias("_times"))
    # the slots come from a range whose size says nothing of theirs: without
    # the hint they would be broadcast on its estimate
    got = (pieces.join(times.hint("merge"), ["_rank", "block"])
           .groupBy("_rank", "_start").agg(F.sum(F.col("piece_words") * F.col("_times")).alias("_got"))
           .select(F.col("_rank").alias("_r"), F.col("_start").alias("_s"), "_got"))
    on = (F.col("_rank") == F.col("_r")) & (F.col("_start") == F.col("_s")) & (F.col("size") > 0)
    return pos.join(got, on, "left").select(
        "doc_id", "size", F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), F.coalesce("_got", F.lit(0)).cast("long").alias("taken"))


def mix_texts(docs: DataFrame, block: int = BLOCK, **kw) -> DataFrame:
    """The mix as documents: for each pass over a source, a document with
    the words the mix takes from it, in order, joined by single spaces. All
    columns of ``docs`` are kept, whatever they are called; ``n_chars`` is renewed. A document of which
    nothing is taken goes."""
    names = docs.columns
    # two hashes of the whole row name it; equal rows are alike in everything
    # and each of their places gets a row of its own below
    cols = [as_col(c) for c in names]
    sized = docs.select(F.struct(*cols).alias("row"), word_count(F.col("text")).alias("_size"),
                        F.xxhash64(*cols).alias("_h1"), F.xxhash64(F.lit(1), *cols).alias("_h2"))
    small = cut(sized.select(F.col("row")["doc_id"].alias("doc_id"), F.col("row")["source"].alias("source"),
                             F.col("_size").alias("size"), "_h1", "_h2"))
    pos, pieces, slots = mix(small, block, salt=("_h1", "_h2"), **kw)
    got = (pieces.join(slots.hint("merge"), ["_rank", "block"])
           .groupBy("_rank", "_start", "epoch")
           .agg(F.sort_array(F.collect_list(F.struct("piece_first", "piece_words"))).alias("_p")))
    spans = (pos.filter("size > 0").select("_rank", "_start", "_h1", "_h2")
             .join(got, ["_rank", "_start"]).select("_h1", "_h2", "_p"))
    words = F.regexp_extract_all(F.col("row")["text"], F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    # the words are bound once: as a column they would be made again for every piece
    text = F.transform(F.array(words), lambda w: F.array_join(F.flatten(F.transform(
        F.col("_p"), lambda p: F.slice(w, (p["piece_first"] + 1).cast("int"),
                                       p["piece_words"].cast("int")))), " "))[0]
    out = (sized.filter("_size > 0").dropDuplicates(["_h1", "_h2"]).join(spans, ["_h1", "_h2"])
           .select("row", text.alias("mixed")))
    new = {"text": F.col("mixed")}
    if "n_chars" in names:
        new["n_chars"] = F.length("mixed").cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col("row")[c]).alias(c) for c in names])
