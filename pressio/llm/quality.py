"""Quality by hierarchical empirical Bayes: document, path and host evidence.

1. A logistic regression on shape features of the whole text, fitted in
   numpy on a bounded sample of labelled rows, gives each document the
   probability that it is good.
2. Grouped sums of that evidence (a label where there is one) give each host
   and each path within it a rate. A host's rate is shrunk toward the global
   one and a path's toward its host's, each by a prior strength that the
   method of moments estimates from the spread of the rates: a site with few
   documents says little.
3. A document's log odds are those of its text, moved by how far its path's
   posterior, without the document's own share, is from the global rate.

The groups are summed before they are shuffled; hosts and paths come back to
their documents by joins that Spark splits where a host is hot.

Defined cases: a text without a word (or NULL) has probability 0 and is
rejected; NULL hosts and paths are groups of their own; a label that is NULL
or not 0 or 1 counts as none, repeated labels of a document as their mean;
without labels of both kinds the text says nothing and every document with
words is kept at probability 0.5; an empty table gives no rows. Rows that
repeat are judged one by one; other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructField, StructType

from ._common import chunks, cut, text_bytes

# Labelled rows fitted on, at most about so many, chosen by a hash of the id.
SAMPLE = 12_000
THRESHOLD = 0.5
# One document's text may not outvote any number of others.
CLIP = 1e-4
PREFIX = "_qc_"

_SPACES = np.zeros(256, bool)
_SPACES[[32, *range(9, 14)]] = True
_CLASSES = {
    "upper": [range(65, 91)], "lower": [range(97, 123)], "digit": [range(48, 58)],
    "high": [range(128, 256)], "line": [[10]],
    **{f"mark{c}": [[c]] for c in range(33, 127) if not chr(c).isalnum()},
}
_MASKS = np.stack([np.isin(np.arange(256), np.concatenate([list(r) for r in v]))
                   for v in _CLASSES.values()]).astype(np.float64)


def shape_features(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A row of features per text: shares of byte classes and of each mark,
    capitals per letter, word length and its spread, distinct words per word,
    distinct lines per line, words on a log scale."""
    n = len(off) - 1
    size = np.diff(off)
    doc = np.repeat(np.arange(n), size)
    hist = np.bincount(doc * 256 + raw, minlength=n * 256).reshape(n, 256).astype(np.float64)
    share = (hist @ _MASKS.T) / np.maximum(size, 1)[:, None]
    names = list(_CLASSES)
    letters = share[:, names.index("upper")] + share[:, names.index("lower")]
    capital = share[:, names.index("upper")] / np.maximum(letters, 1e-9)
    rest = np.zeros((n, 6))
    blob = raw.tobytes()
    for i in range(n):
        text = blob[off[i]:off[i + 1]]
        words = text.split()
        if words:
            lengths = np.fromiter(map(len, words), np.float64, len(words))
            lines = text.split(b"\n")
            rest[i] = (lengths.mean() / 10, lengths.std() / 10, len(set(words)) / len(words),
                       len(set(lines)) / len(lines), np.log1p(len(words)) / 10,
                       np.log1p(len(words) / len(lines)) / 10)
    x = np.concatenate([np.sqrt(share), capital[:, None], rest], axis=1)
    return x.astype(np.float32)


def _features(docs: DataFrame, text: str) -> DataFrame:
    names = docs.columns
    kept = [c for c in names if c != text]

    def run(batches):
        for batch in batches:
            for lo, hi in chunks(batch, text, 4_000_000):
                part = batch.slice(lo, hi - lo)
                raw, off = text_bytes(part.column(text))
                x = shape_features(raw, off)
                col = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], col],
                                                 names=[*kept, f"{PREFIX}x"])

    schema = StructType([*[docs.schema[c] for c in kept],
                         StructField(f"{PREFIX}x", ArrayType(FloatType()))])
    return docs.mapInArrow(run, schema)


class Classifier:
    """Logistic regression on standardised features, by Newton steps with a
    ridge; balanced for nothing: its prior is that of the sample."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
        z = self._z(x)
        w = np.zeros(z.shape[1])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            g = z.T @ (p - y) + ridge * w
            h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
            step = np.linalg.solve(h, g)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        self.w = w

    def _z(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x.astype(np.float64) - self.mean) / self.scale, -8, 8)
        return np.concatenate([np.ones((len(z), 1)), z, z * z / 8], axis=1)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._z(x) @ self.w, -30, 30)))


def _labels(labels: DataFrame, key: str, label: str) -> DataFrame:
    good = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1))
    return good.groupBy(F.col(key).alias(f"{PREFIX}id")).agg(
        F.avg(F.col(label).cast("double")).alias(f"{PREFIX}y"))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        label: str = "quality", sample: int = SAMPLE) -> Classifier | None:
    """Learn from at most about ``sample`` labelled texts; only their
    features reach the driver."""
    y = _labels(labels, key, label)
    n = y.count()
    if not n:
        return None
    unit = 1_000_000
    some = y.filter(F.pmod(F.xxhash64(f"{PREFIX}id"), F.lit(unit)) < min(unit, unit * sample // n + 1))
    rows = docs.select(F.col(key).alias(f"{PREFIX}id"), F.col(text).alias("text")) \
        .join(some, f"{PREFIX}id")
    got = _features(rows, "text").collect()
    x = np.array([r[f"{PREFIX}x"] for r in got], dtype=np.float32)
    target = np.array([r[f"{PREFIX}y"] >= 0.5 for r in got], dtype=np.float64)
    if len(got) == 0 or target.min() == target.max():
        return None
    order = np.lexsort([*x.T[::-1], target])  # the same sums whatever order rows came in
    return Classifier(x[order], target[order])


def _evidence(docs: DataFrame, model: Classifier | None, text: str, out: str) -> DataFrame:
    """``docs`` with the classifier's probability, NULL for texts without words."""
    names = docs.columns

    def run(batches):
        for batch in batches:
            for lo, hi in chunks(batch, text, 4_000_000):
                part = batch.slice(lo, hi - lo)
                raw, off = text_bytes(part.column(text))
                size, seen = np.diff(off), np.zeros(hi - lo, np.int64)
                np.add.at(seen, np.repeat(np.arange(hi - lo), size)[~_SPACES[raw]], 1)
                p = model(shape_features(raw, off)) if model else np.full(hi - lo, 0.5)
                p = pa.array(np.clip(p, CLIP, 1 - CLIP), mask=seen == 0)
                yield pa.RecordBatch.from_arrays([*part.columns, p], names=[*names, out])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, DoubleType())]))


def _strength(groups: DataFrame, rate, n) -> "F.Column":
    """Prior strength from the spread of group rates around their mean, by
    moments: what exceeds the spread that the groups' sizes alone give."""
    m = F.sum(rate * n) / F.sum(n)
    spread = F.sum(n * rate * rate) / F.sum(n) - m * m
    noise = m * (1 - m) * F.count(F.lit(1)) / F.sum(n)
    between = F.greatest(spread - noise, F.lit(1e-6))
    return F.least(F.greatest(m * (1 - m) / between - 1, F.lit(1.0)), F.lit(1e6))


def _log_odds(p):
    return F.log(p / (1 - p))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **kw) -> DataFrame:
    """``docs`` with p_doc, host_rate, path_rate, p_quality and kept, which
    replace columns of these names."""
    made = {"p_doc": F.coalesce(f"{PREFIX}p", F.lit(0.0)), "host_rate": F.col(f"{PREFIX}r"),
            "path_rate": F.col(f"{PREFIX}b"), "p_quality": F.col(f"{PREFIX}f"),
            "kept": F.col(f"{PREFIX}f") >= threshold}
    return _judged(docs, labels, **kw).select(
        *[c for c in docs.columns if c not in made], *[v.alias(k) for k, v in made.items()])


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                   **kw) -> DataFrame:
    """``docs`` without those that :func:`judge` rejects, columns as they were."""
    return _judged(docs, labels, **kw).filter(F.col(f"{PREFIX}f") >= threshold).select(*docs.columns)


def _judged(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
            host: str = "source", path: str = "lang", label: str = "quality",
            sample: int = SAMPLE) -> DataFrame:
    """``docs`` with what :func:`judge` reports, under prefixed names."""
    model = fit(docs, labels, key, text, label, sample)
    p, y = f"{PREFIX}p", f"{PREFIX}y"
    scored = _evidence(docs, model, text, p)
    lab = _labels(labels, key, label)
    # sites are summed over rows without the text
    small = _evidence(docs.select(F.col(key).alias(f"{PREFIX}k"), F.col(host).alias(f"{PREFIX}h"),
                                  F.col(path).alias(f"{PREFIX}q"), F.col(text).alias(f"{PREFIX}t")),
                      model, f"{PREFIX}t", p).drop(f"{PREFIX}t")
    small = small.join(lab, F.col(f"{PREFIX}k") == F.col(f"{PREFIX}id"), "left")
    e = F.coalesce(F.col(y), F.col(p), F.lit(CLIP))
    # one row per path: kept, so that the texts are scored once for it
    paths = cut(small.groupBy(f"{PREFIX}h", f"{PREFIX}q")
                .agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(e).alias("s")))
    hosts = paths.groupBy(f"{PREFIX}h").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    whole = hosts.agg((F.sum("hs") / F.sum("hn")).alias("m"),
                      _strength(hosts, F.col("hs") / F.col("hn"), F.col("hn")).alias("k"))
    got = whole.first()
    m = min(max(got["m"] if got["m"] is not None else 0.5, CLIP), 1 - CLIP)
    k = got["k"] or 1.0
    hosts = hosts.withColumn("host_rate", (F.col("hs") + k * m) / (F.col("hn") + k))
    kp = paths.agg(_strength(paths, F.col("s") / F.col("n"), F.col("n")).alias("k")).first()["k"] or 1.0
    sites = (paths.withColumnRenamed(f"{PREFIX}h", f"{PREFIX}g")
             .join(hosts.select(F.col(f"{PREFIX}h"), "host_rate"),
                   F.col(f"{PREFIX}g").eqNullSafe(F.col(f"{PREFIX}h")))
             .select(F.col(f"{PREFIX}h"), F.col(f"{PREFIX}q"), F.col("n").alias(f"{PREFIX}n"),
                     F.col("s").alias(f"{PREFIX}s"), F.col("host_rate").alias(f"{PREFIX}r")))
    out = scored.join(sites, F.col(host).eqNullSafe(F.col(f"{PREFIX}h"))
                      & F.col(path).eqNullSafe(F.col(f"{PREFIX}q")), "left")
    own = F.coalesce(F.col(p), F.lit(CLIP))
    others = F.least(F.greatest(
        (F.col(f"{PREFIX}s") - own + kp * F.col(f"{PREFIX}r")) / (F.col(f"{PREFIX}n") - 1 + kp),
        F.lit(CLIP)), F.lit(1 - CLIP))
    odds = _log_odds(F.col(p)) + _log_odds(others) - _log_odds(F.lit(m))
    if model is None:
        odds = _log_odds(F.col(p))
    quality = F.coalesce(1 / (1 + F.exp(-odds)), F.lit(0.0))
    return out.withColumn(f"{PREFIX}b", others).withColumn(f"{PREFIX}f", quality)
