"""Exact top-k search by inner product: a Voronoi kNN join.

Queries and data are grouped by their nearest of a bounded number of pivots.
A pass over the data leaves, per query group, the k largest lower bounds of
any of its queries' scores; the k-th is a floor under the k-th best score of
every query of the group. For a group with pivot p and radius r, a vector d
scores between p.d - r|d| and p.d + r|d| with each of its queries, so only
vectors whose upper bound reaches the floor are replicated to the group.
Data cells whose centre, radius and longest vector rule the group out
are skipped as a whole. Groups are solved locally, block by block, and the
blocks' best are merged.

Scores below 2^53 are exact in double precision; bounds are widened by a
relative 1e-9, which can only replicate more. Vectors whose components could
go past that are left out of this and meet every vector in blocks of their
own, scored as integers. A score in the result that no long holds fails the job.

Defined cases: vectors that are NULL, empty, of another length than most, or
hold NULL or non-finite components, and rows without an id, take no part;
ties go to the smaller id; rows that share an id are vectors of their own,
but never candidates of a query with that id; fewer than k candidates give
fewer rows; an empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIVOTS = 64
SCALE = 256
QUERY_BLOCK = 512
DATA_BLOCK = 2048
SLACK = 1e-9
# Largest allowed sum of products that double precision holds exactly.
EXACT = float(1 << 53)


def quantised(df: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(id, v): floor(scale * x) of each component, of the vectors that take part."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = (df.select(F.col(key).cast("long").alias("id"), v.alias("_v"), bad.alias("_bad"))
            .filter("id is not null and _v is not null and size(_v) > 0 and not _bad"))
    def floor(x):
        # from 2^53 on doubles are whole, and may be past a long
        return F.when(F.abs(x) >= EXACT, x).otherwise(F.floor(x).cast("double"))
    return rows.select("id", F.transform("_v", lambda x: floor(x * F.lit(float(scale)))).alias("v"))


def _wide(v: str = "v") -> Column:
    """Whether doubles may not hold the vector's scores with such as it."""
    most = F.array_max(F.transform(v, F.abs))
    return most * most * F.size(v) >= F.lit(EXACT)


def _matrix(col, dim: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return np.asarray(col.flatten(), dtype=np.float64).reshape(-1, dim)


def _nearest(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    d = (pivots * pivots).sum(axis=1)[None, :] - 2 * (x @ pivots.T)
    return d.argmin(axis=1)


def _pivots(vectors: DataFrame, dim: int, n: int) -> np.ndarray:
    """``n`` vectors with the smallest hashes of their ids: the same at every run."""
    rows = (vectors.select(F.xxhash64("id").alias("h"), "id", "v")
            .orderBy("h", "id", "v").limit(n).collect())
    return np.array([r["v"] for r in rows], dtype=np.float64).reshape(-1, dim)


def top_k(queries: DataFrame, data: DataFrame, k: int = 5, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k largest inner products of each
    query (id, v) with data (id, v) of another id."""
    empty = "query_id long, rank int, vec_id long, score long"
    lengths = data.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if lengths is None:
        return data.sparkSession.createDataFrame([], empty)
    dim = lengths["n"]
    data, queries = data.filter(F.size("v") == dim), queries.filter(F.size("v") == dim)
    if not data.filter(_wide()).take(1) and not queries.filter(_wide()).take(1):
        return _ranked(_pruned(queries, data, k, pivots, dim), k)
    plain, far = data.filter(~_wide()), data.filter(_wide())
    best = (_exact(queries.filter(_wide()), data, k, dim)
            .unionByName(_exact(queries.filter(~_wide()), far, k, dim)))
    if plain.take(1):
        best = best.unionByName(_pruned(queries.filter(~_wide()), plain, k, pivots, dim))
    fits = F.when(F.col("score").isNull(), F.raise_error(F.lit("scores too large for a long")).cast("long"))
    return _ranked(best, k).withColumn("score", fits.otherwise(F.col("score")))


def _ranked(best: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _exact(queries: DataFrame, data: DataFrame, k: int, dim: int) -> DataFrame:
    """(query_id, vec_id, score) of the k best in each block of data, by
    integers of any length; NULL where a long is too small for a score."""
    def packed(size):
        def pack(batches):
            for batch in batches:
                x, ids = _matrix(batch.column("v"), dim), np.asarray(batch.column("id"))
                for a in range(0, len(ids), size):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([np.ascontiguousarray(c[a:a + size]).tobytes()], pa.binary()) for c in (ids, x)],
                        names=["ids", "m"])
        return pack

    def solve(batches):
        for batch in batches:
            for r in batch.to_pylist():
                qi, di = (np.frombuffer(r[c], np.int64) for c in ("qids", "ids"))
                q, d = (np.frombuffer(r[c], np.float64).reshape(-1, dim) for c in ("qm", "m"))
                kind = np.int64 if np.abs(q).max() * np.abs(d).max() * dim < 2.0 ** 62 else object
                q, d = ([[int(x) for x in v] for v in m.tolist()] for m in (q, d))
                s = (np.array(q, kind) @ np.array(d, kind).T).tolist()
                out = []
                for i, row in zip(qi.tolist(), s):
                    met = sorted((-x, j) for x, j in zip(row, di.tolist()) if j != i)[:k]
                    if met and -met[0][0] >= 1 << 63:
                        raise ValueError("scores too large for a long")
                    out += [(i, j, -x if x <= 1 << 63 else None) for x, j in met]
                yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], pa.int64()) for c in range(3)],
                                                 names=["query_id", "vec_id", "score"])

    kind = "ids binary, m binary"
    qb = queries.mapInArrow(packed(QUERY_BLOCK), kind).toDF("qids", "qm")
    return qb.crossJoin(data.mapInArrow(packed(DATA_BLOCK), kind)).mapInArrow(
        solve, "query_id long, vec_id long, score long")


def _pruned(queries: DataFrame, data: DataFrame, k: int, pivots: int, dim: int) -> DataFrame:
    """(query_id, vec_id, score) of the k best of each query and more, of
    vectors whose scores doubles hold exactly."""
    empty = "query_id long, vec_id long, score long"
    p = _pivots(data, dim, pivots)

    # one row per pivot: the group's radius
    def radii(batches):
        r = np.full(len(p), -1.0)
        for batch in batches:
            x = _matrix(batch.column("v"), dim)
            if len(x):
                g = _nearest(x, p)
                np.maximum.at(r, g, np.sqrt(((x - p[g]) ** 2).sum(axis=1)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(p)), pa.int32()), pa.array(r)],
                                         names=["g", "r"])

    r = np.full(len(p), -1.0)
    for row in queries.select("v").mapInArrow(radii, "g int, r double").groupBy("g").agg(
            F.max("r").alias("r")).collect():
        r[row["g"]] = row["r"]
    live = np.flatnonzero(r >= 0)
    if not len(live):
        return data.sparkSession.createDataFrame([], empty)
    pl, rl = p[live], r[live] * (1 + SLACK)

    # Data cells' summaries and, per query group, the k + 1 largest lower
    # bounds: k + 1, as one of them may be the query itself.
    def summaries(batches):
        best = np.full((len(live), 0), -np.inf)
        radius, longest = np.full(len(p), -1.0), np.zeros(len(p))
        for batch in batches:
            x = _matrix(batch.column("v"), dim)
            if not len(x):
                continue
            norm = np.sqrt((x * x).sum(axis=1))
            c = _nearest(x, p)
            np.maximum.at(radius, c, np.sqrt(((x - p[c]) ** 2).sum(axis=1)))
            np.maximum.at(longest, c, norm)
            low = pl @ x.T - rl[:, None] * norm[None, :]
            low -= SLACK * np.abs(low)
            best = -np.sort(-np.concatenate([best, low], axis=1), axis=1)[:, :k + 1]
        cells = [(int(i), [float(radius[i]), float(longest[i])], True) for i in np.flatnonzero(radius >= 0)]
        groups = [(int(i), best[i].tolist(), False) for i in range(len(live))] if best.shape[1] else []
        rows = cells + groups
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in rows], pa.int32()),
             pa.array([x[1] for x in rows], pa.list_(pa.float64())),
             pa.array([x[2] for x in rows], pa.bool_())], names=["g", "x", "cell"])

    floor, cell_r, cell_n = np.full(len(live), -np.inf), np.full(len(p), -1.0), np.zeros(len(p))
    parts = data.select("v").mapInArrow(summaries, "g int, x array<double>, cell boolean")
    top = F.slice(F.reverse(F.sort_array(F.flatten(F.collect_list("x")))), 1, k + 1)
    merged = parts.groupBy("cell", "g", F.pmod(F.spark_partition_id(), F.lit(64)).alias("part")).agg(
        F.when(F.first("cell"), F.array(F.max(F.get("x", F.lit(0))), F.max(F.get("x", F.lit(1))))).otherwise(top).alias("x"))
    merged = merged.groupBy("cell", "g").agg(
        F.when(F.first("cell"), F.array(F.max(F.get("x", F.lit(0))), F.max(F.get("x", F.lit(1))))).otherwise(top).alias("x"))
    for row in merged.collect():
        if row["cell"]:
            cell_r[row["g"]], cell_n[row["g"]] = row["x"]
        elif len(row["x"]) > k:
            floor[row["g"]] = row["x"][k]

    # Upper bound of a whole data cell for a query group.
    far = pl @ p.T + rl[:, None] * cell_n[None, :] + np.sqrt((pl * pl).sum(axis=1))[:, None] * cell_r[None, :]
    reach = far + SLACK * np.abs(far) >= floor[:, None]

    def blocks(batches, size, groups_of):
        """Rows (g, ids, matrix) of up to ``size`` vectors, as they fill up."""
        held: dict[int, list] = {}
        for batch in batches:
            x, ids = _matrix(batch.column("v"), dim), np.asarray(batch.column("id"))
            for g, at in groups_of(x):
                if len(at):
                    held.setdefault(g, []).append((ids[at], x[at].astype(np.int32)))
                    if sum(len(i) for i, _ in held[g]) >= size:
                        yield from _pack(g, held.pop(g), size)
        for g in list(held):
            yield from _pack(g, held.pop(g), size)

    def _pack(g, parts, size):
        ids, x = np.concatenate([i for i, _ in parts]), np.concatenate([m for _, m in parts])
        for a in range(0, len(ids), size):
            yield pa.RecordBatch.from_arrays(
                [pa.array([g], pa.int32()), pa.array([ids[a:a + size].tobytes()], pa.binary()),
                 pa.array([x[a:a + size].tobytes()], pa.binary())], names=["g", "ids", "m"])

    def query_blocks(batches):
        def groups(x):
            g = _nearest(x, p)
            return [(int(i), np.flatnonzero(g == i)) for i in np.unique(g)]
        yield from blocks(batches, QUERY_BLOCK, groups)

    def data_blocks(batches):
        def groups(x):
            norm, c = np.sqrt((x * x).sum(axis=1)), _nearest(x, p)
            up = pl @ x.T + rl[:, None] * norm[None, :]
            hit = (up + SLACK * np.abs(up) >= floor[:, None]) & reach[:, c]
            return [(int(live[i]), np.flatnonzero(hit[i])) for i in range(len(live))]
        yield from blocks(batches, DATA_BLOCK, groups)

    def solve(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                qi, di = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in ("qids", "ids"))
                q, d = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int32).reshape(-1, dim)
                        .astype(np.float64) for c in ("qm", "m"))
                order = np.argsort(di, kind="stable")     # ties: the smaller id first
                di, d = di[order], d[order]
                s = q @ d.T
                s[qi[:, None] == di[None, :]] = -np.inf
                out_q, out_d, out_s = [], [], []
                for j in range(len(qi)):
                    cut_at = np.partition(s[j], -k)[-k] if len(di) > k else -np.inf
                    at = np.flatnonzero((s[j] >= cut_at) & (s[j] > -np.inf))
                    at = at[np.argsort(-s[j][at], kind="stable")][:k]
                    out_q.append(np.full(len(at), qi[j]))
                    out_d.append(di[at])
                    out_s.append(s[j][at].astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in (out_q, out_d, out_s)],
                    names=["query_id", "vec_id", "score"])

    kind = "g int, ids binary, m binary"
    qb = queries.mapInArrow(query_blocks, kind).select(
        "g", F.col("ids").alias("qids"), F.col("m").alias("qm"))
    db = data.mapInArrow(data_blocks, kind)
    # merge: the sizes of blocks say nothing to the planner, and a hot group's
    # side is split; then the pairs of blocks are dealt out evenly
    met = qb.hint("merge").join(db, "g")
    return met.mapInArrow(solve, "query_id long, vec_id long, score long")
