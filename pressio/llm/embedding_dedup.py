"""Near-duplicate embeddings through an inverted multi-index.

Unit vectors are cut into halves, each with a codebook of its own; the
product of the two codebooks is a grid of cells. A vector lies in one cell
and, as a query, visits cells in the order of the summed squared distances
of its halves to their centres (the multi-sequence order), until so many
that the target recall is met. That number is measured on a bounded sample of
queries, and is what the harder of two tests asks for: ``PARTNERS`` made
vectors at the threshold's distance of each query, in random directions, and
the links that the queries have by brute force, each linked query counting
alike. Nothing bounds it but the grid itself, with which nothing is missed. Cells
that the bisecting planes put beyond the threshold's distance end a
traversal early without losing anything. Candidates are verified in double
precision.

The codebooks grow with the table (``per_cell`` vectors to a cell on
average) and are fitted on a bounded sample; every vector is indexed.

Equal vectors of a label are one class and never meet each other. Cells are
solved in blocks: what leaves a task is the number of links of each vector
and a spanning forest of the links in the block, not the links themselves.
A link that only one of two vectors finds counts for both.

Defined cases: vectors that are NULL, empty, zero, of another length than
most, or hold NULL or non-finite components, and vectors with a NULL label,
link with nothing; a NULL id comes back with a NULL component, kept; rows
that share an id are vectors of their own (two equal ones are linked, two
different ones are not compared) in one component; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import cut
from .components import connected_components

RECALL = 0.999
PER_CELL = 256
LARGEST_CODEBOOK = 2048
SAMPLE_PER_CODE = 64
CALIBRATION = 256
PARTNERS = 16
LEAST_VISITS = 4
BLOCK = 1024
CHUNK = 1 << 22                   # numbers held at once in a traversal


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    m = max(1, x.shape[1] // 2)
    return x[:, :m], x[:, m:]


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2 * x @ c.T, 0)


def _codebook(x: np.ndarray, k: int, seed: int, steps: int = 12) -> np.ndarray:
    """Lloyd's iterations from k distinct rows."""
    rng = np.random.default_rng(seed)
    rows = np.unique(x, axis=0)
    c = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)]
    for _ in range(steps):
        a = _distances(x, c).argmin(axis=1)
        n = np.bincount(a, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, a, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


class MultiIndex:
    def __init__(self, sample: np.ndarray, k: int, threshold: float):
        self.books = [_codebook(h, k, i) for i, h in enumerate(_halves(sample))]
        self.reach = 2 - 2 * threshold + 1e-9       # squared distance at the threshold

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = (_distances(h, c).argmin(axis=1) for h, c in zip(_halves(x), self.books))
        return a.astype(np.int64) * len(self.books[1]) + b

    def traversals(self, x: np.ndarray, visits: int) -> np.ndarray:
        """The first ``visits`` cells of each row in multi-sequence order, -1
        where the traversal has ended."""
        # the cell of the i-th and j-th code in order has (i + 1)(j + 1) - 1 before it
        n = [min(visits, len(c)) for c in self.books]
        pairs = np.array([(i, j) for i in range(n[0]) for j in range(min(n[1], visits // (i + 1)))])
        step = max(1, CHUNK // max(len(pairs), sum(map(len, self.books))))
        return np.concatenate([self._traversals(x[lo:lo + step], visits, pairs)
                               for lo in range(0, max(len(x), 1), step)])

    def _traversals(self, x: np.ndarray, visits: int, pairs: np.ndarray) -> np.ndarray:
        total, out_of, cell = 0, 0, 0
        for at, h, c in zip(pairs.T, _halves(x), self.books):
            t = _distances(h, c)
            gap = np.sqrt(_distances(c, c))[t.argmin(axis=1)]
            lb = (t - t.min(axis=1)[:, None]) / np.maximum(2 * gap, 1e-12)
            far = np.where(gap > 0, np.maximum(lb, 0), 0) ** 2
            order = np.argsort(t, axis=1, kind="stable")[:, at]
            total = total + np.take_along_axis(t, order, axis=1)
            out_of = out_of + np.take_along_axis(far, order, axis=1)
            cell = cell * len(c) + order
        total = np.where(out_of > self.reach, np.inf, total)
        order = np.argsort(total, axis=1, kind="stable")[:, :visits]
        found = np.take_along_axis(cell, order, axis=1)
        return np.where(np.isinf(np.take_along_axis(total, order, axis=1)), -1, found)

    def visits_to(self, q: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """How many cells of row q[i]'s order end with cells[i], ties included."""
        d = [_distances(h, c) for h, c in zip(_halves(q), self.books)]
        last = np.sort(d[1], axis=1)
        out = np.empty(len(q), np.int64)
        for i, cell in enumerate(cells):
            total = d[0][i][cell // len(self.books[1])] + d[1][i][cell % len(self.books[1])]
            left = total * (1 + 1e-9) + 1e-12 - d[0][i]
            out[i] = np.searchsorted(last[i], left, side="right").sum()
        return out


def _unit(col, dim: int) -> np.ndarray:
    x = np.asarray(col.flatten(), dtype=np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1)[:, None]      # squares stay within range
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _rows(rows: list) -> pa.Array:
    return pa.array([r["v"] for r in rows], pa.list_(pa.float64()))


def _usable(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("v", lambda x: x != 0)
    return (df.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"),
                      F.col(vector).alias("v"))
            .filter("id is not null and label is not null and v is not null and size(v) > 0")
            .filter(~bad).filter(some))


def _step(visits: np.ndarray) -> np.ndarray:
    """Numbers rounded up to steps of a tenth, so that few differ."""
    return np.where(visits < 16, visits, np.ceil(1.1 ** np.ceil(np.log(np.maximum(visits, 1)) / np.log(1.1) - 1e-9))).astype(np.int64)


def _partners(q: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of q and unit vectors at the threshold's cosine to them."""
    rng = np.random.default_rng(7)
    at = np.repeat(np.arange(len(q)), PARTNERS)
    away = rng.normal(size=(len(at), q.shape[1]))
    away -= (away * q[at]).sum(axis=1)[:, None] * q[at]
    away /= np.maximum(np.sqrt((away * away).sum(axis=1)), 1e-300)[:, None]
    return at, threshold * q[at] + math.sqrt(max(0.0, 1 - threshold * threshold)) * away


def _enough(query: np.ndarray, need: np.ndarray, n: np.ndarray, recall: float) -> int:
    """The smallest number of visits that hold the target share of links,
    each query counting alike. (query, need, n): links met at that visit."""
    if not len(query):
        return LEAST_VISITS
    weight = n / np.bincount(query, weights=n)[query]
    order = np.argsort(need, kind="stable")
    share = np.cumsum(weight[order]) / len(np.unique(query))
    return int(need[order][min(np.searchsorted(share, recall - 1e-12), len(order) - 1)])


def _visits(classes: DataFrame, index: MultiIndex, queries: list, dim: int, threshold: float,
            recall: float) -> int:
    """Cells to visit so that links, and vectors at the threshold's distance,
    are found with the target recall."""
    grid = len(index.books[0]) * len(index.books[1])
    labels = np.array([str(r["label"]) for r in queries])
    q = _unit(_rows(queries), dim)
    ids = np.array([r["id"] for r in queries], dtype=np.int64)
    at, made = _partners(q, threshold)
    made_need = _step(index.visits_to(q[at], index.cells(made)))

    def ranks(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                x = _unit(part.column("v"), dim)
                same = labels[:, None] == np.array(part.column("label").to_pylist())[None, :]
                hit = (q @ x.T >= threshold) & same
                hit &= ids[:, None] != np.asarray(part.column("id"))[None, :]
                i, j = np.nonzero(hit)
                if len(i):
                    met, n = np.unique(np.stack([i, index.cells(x)[j]]), axis=1, return_counts=True)
                    need = _step(index.visits_to(q[met[0]], met[1]))
                    yield pa.RecordBatch.from_arrays([pa.array(met[0]), pa.array(need), pa.array(n)],
                                                     names=["q", "need", "n"])

    text = classes.select("id", F.col("label").cast("string").alias("label"), "v")
    real = text.mapInArrow(ranks, "q long, need long, n long").groupBy("q", "need").agg(F.sum("n").alias("n")).collect()
    real = np.array([tuple(r) for r in real], dtype=np.int64).reshape(-1, 3)
    needed = max(_enough(*real.T, recall), _enough(at, made_need, np.ones(len(at)), recall))
    return min(max(LEAST_VISITS, needed), grid)


def _forest(i: np.ndarray, j: np.ndarray, a: np.ndarray, b: np.ndarray):
    """Edges (node, smallest node) of the components of links a[i] - b[j]."""
    nodes, at = np.unique(np.concatenate([a[i], b[j]]), return_inverse=True)
    x, y = at[:len(i)], at[len(i):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        root = root[root]
        if np.array_equal(root, before):
            break
    away = root != np.arange(len(nodes))
    return nodes[away], nodes[root[away]]


def _blocks(rows: DataFrame, size: int, visits: int) -> DataFrame:
    """Rows of a (label, cell) packed into blocks of up to ``size``."""
    def pack(batches):
        key, held = None, []

        def out():
            cols = [np.concatenate([np.asarray(h[c]).reshape(len(h["id"]), -1) for h in held])
                    for c in ("id", "m", "own", "trip", "v")]
            for lo in range(0, len(cols[0]), size):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key[0]], pa.string()), pa.array([key[1]], pa.int64())]
                    + [pa.array([np.ascontiguousarray(c[lo:lo + size]).tobytes()], pa.binary())
                       for c in cols],
                    names=["label", "cell", "id", "m", "own", "trip", "v"])

        for batch in batches:
            labels, cells = batch.column("label").to_pylist(), np.asarray(batch.column("cell"))
            if not len(cells):
                continue
            edge = [0, *[k for k in range(1, len(cells)) if cells[k] != cells[k - 1]
                         or labels[k] != labels[k - 1]], len(cells)]
            for lo, hi in zip(edge, edge[1:]):
                this = (labels[lo], int(cells[lo]))
                if held and (this != key or sum(len(h["id"]) for h in held) >= size):
                    yield from out()
                    held = []
                key, part = this, batch.slice(lo, hi - lo)
                n = hi - lo
                held.append({
                    "id": np.asarray(part.column("id")), "m": np.asarray(part.column("m")),
                    "own": np.asarray(part.column("own")),
                    "trip": np.asarray(part.column("trip").flatten()).reshape(n, visits),
                    "v": np.asarray(part.column("v").flatten(), dtype=np.float64).reshape(n, -1)})
        if held:
            yield from out()

    sorted_ = rows.repartition("label", "cell").sortWithinPartitions("label", "cell", "id")
    return sorted_.mapInArrow(pack, "label string, cell long, id binary, m binary, own binary, "
                                    "trip binary, v binary")


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding",
                    label: str = "label", threshold: float = 0.93, recall: float = RECALL,
                    per_cell: int = PER_CELL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``df``."""
    good = _usable(df, key, vector, label)
    lengths = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dim = lengths["n"] if lengths else 1
    good = good.filter(F.size("v") == dim)
    digest = [F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")]
    classes = cut(good.select("id", F.col("label").cast("string").alias("label"), "v", *digest)
                  .groupBy("label", "h1", "h2")
                  .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("m"), F.first("v").alias("v")))
    n = classes.count()
    k = min(max(4, math.ceil(math.sqrt(n / per_cell))), LARGEST_CODEBOOK)
    by_hash = classes.orderBy(F.xxhash64("id"), "id", "h1").select("id", "label", "v")
    sample = by_hash.limit(SAMPLE_PER_CODE * k).collect()
    if not sample:
        return _result(df, key, vector, label, classes.selectExpr(
            "label _l", "h1 _h1", "h2 _h2", "m _n", "id _c"))
    index = MultiIndex(_unit(_rows(sample), dim), k, threshold)
    visits = _visits(classes, index, sample[:CALIBRATION], dim, threshold, recall)

    def place(batches):
        for batch in batches:
            step = max(1, min(2048, CHUNK // visits))
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                u = _unit(part.column("v"), dim)
                trip = index.traversals(u, visits)
                trip = np.pad(trip, ((0, 0), (0, visits - trip.shape[1])), constant_values=-1)
                off = pa.array(np.arange(len(u) + 1, dtype=np.int32) * visits)
                voff = pa.array(np.arange(len(u) + 1, dtype=np.int32) * dim)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("m"), part.column("label"),
                     pa.array(index.cells(u)), pa.ListArray.from_arrays(off, pa.array(trip.ravel())),
                     pa.ListArray.from_arrays(voff, pa.array(u.ravel()))],
                    names=["id", "m", "label", "own", "trip", "v"])

    placed = classes.select("id", "m", "label", "v").mapInArrow(
        place, "id long, m long, label string, own long, trip array<long>, v array<double>")
    data = _blocks(placed.withColumn("cell", F.col("own")), BLOCK, visits)
    # only the data's side needs the cells that it visits itself
    asked = placed.withColumn("cell", F.explode("trip")).filter("cell >= 0")
    asked = _blocks(asked.withColumn("trip", F.array().cast("array<long>")), BLOCK, 0)

    def solve(batches):
        for batch in batches:
            for r in batch.to_pylist():
                qi, qm, qo = (np.frombuffer(r[c], np.int64) for c in ("qid", "qm", "qown"))
                di, dm = (np.frombuffer(r[c], np.int64) for c in ("id", "m"))
                trip = np.frombuffer(r["trip"], np.int64).reshape(len(di), -1)
                q, d = (np.frombuffer(r[c], np.float64).reshape(-1, dim) for c in ("qv", "v"))
                hit = q @ d.T >= threshold
                hit &= qi[:, None] != di[None, :]
                i, j = np.nonzero(hit)
                if not len(i):
                    continue
                links = np.zeros(len(qi), np.int64)
                np.add.at(links, i, dm[j])
                owns, own = np.unique(qo, return_inverse=True)
                back_to = np.array([(trip == c).any(axis=1) for c in owns])
                unseen = ~back_to[own[i], j]            # the other does not visit back
                back = np.zeros(len(di), np.int64)
                np.add.at(back, j[unseen], qm[i[unseen]])
                s, t = links > 0, back > 0
                a, b = _forest(i, j, qi, di)
                ids = np.concatenate([qi[s], di[t], a])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(np.concatenate([links[s], back[t], np.zeros_like(a)])),
                     pa.array(np.concatenate([qi[s], di[t], b]))], names=["id", "n", "to"])

    met = asked.select("label", "cell", F.col("id").alias("qid"), F.col("m").alias("qm"),
                       F.col("own").alias("qown"), F.col("v").alias("qv")).hint("merge") \
        .join(data.drop("own"), ["label", "cell"])
    found = cut(met.mapInArrow(solve, "id long, n long, to long").groupBy("id", "to")
                .agg(F.sum("n").alias("n")))
    comps = connected_components(found.filter("id <> to"), "id", "to")
    links = found.groupBy("id").agg(F.sum("n").alias("_far"))
    reps = (classes.join(links, "id", "left").join(
        comps.select(F.col("node").alias("id"), "component"), "id", "left")
        .select(F.col("label").alias("_l"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"),
                (F.coalesce("_far", F.lit(0)) + F.col("m") - 1).alias("_n"),
                F.coalesce("component", "id").alias("_c")))
    return _result(df, key, vector, label, reps)


def _result(df: DataFrame, key: str, vector: str, label: str, reps: DataFrame) -> DataFrame:
    """Every row with the links and component of its class, or none."""
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("string").alias("_label"),
                     F.xxhash64(F.col(vector)).alias("_d1"), F.xxhash64(F.lit(1), F.col(vector)).alias("_d2"))
    of = ((F.col("_label") == F.col("_l")) & (F.col("_d1") == F.col("_h1"))
          & (F.col("_d2") == F.col("_h2")) & F.col("vec_id").isNotNull())
    component = F.coalesce("_c", "vec_id")
    return rows.join(reps, of, "left").select(
        "vec_id", F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
