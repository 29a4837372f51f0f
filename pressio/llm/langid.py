"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is the mean of the embeddings of its character 1- to 4-grams, hashed
into ``BUCKETS`` rows; a linear layer and a softmax follow. Both are trained
by stochastic gradient descent in numpy, on a bounded sample of labelled
texts. Part of that sample is held back to fit the softmax's temperature and
the score under which a prediction counts as rejected. Prediction folds
embeddings and linear layer into one score per bucket and language, and
sums it over every n-gram of the whole text.

Defined cases: a text that is NULL or holds no letter is ``und`` with score
0 and rejected; with nothing to learn from, every text is; a NULL language
is not learnt from; with one language that one is predicted. Repeated rows
are predicted one by one, all alike. Other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from ._common import chunks

BUCKETS = 1 << 16
ORDERS = 4
DIM = 16
# Labelled texts learnt from, per language, at most about so many: a hash of
# the document id decides which, at every size alike.
PER_LANGUAGE = 600
EPOCHS = 6
RATE = 4.0
# Rejected: scores under which fewer than this share was right, held back.
PRECISION = 0.99
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray       # bucket x language
    bias: np.ndarray
    temperature: float
    threshold: float


def _buckets(codes: np.ndarray, order: int, h: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Running hash of the n-grams of ``order`` at each position, and their buckets."""
    with np.errstate(over="ignore"):
        if h is None:
            h = codes * np.uint32(0x9E3779B1) + np.uint32(1)
        else:
            h = h[:-1] * np.uint32(0x01000193) + codes[order - 1:] * np.uint32(0x85EBCA6B)
        x = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        return h, (x >> np.uint32(32 - 16)).astype(np.int32) & (BUCKETS - 1)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and the share of its n-grams in each."""
    codes, h, found = _codes(text), None, []
    for k in range(1, min(ORDERS, len(codes)) + 1):
        h, b = _buckets(codes, k, h)
        found.append(b)
    u, c = np.unique(np.concatenate(found), return_counts=True)
    return u, (c / c.sum()).astype(np.float64)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(texts: list[str], languages: list[str], seed: int = 7) -> Model | None:
    """Fit on the given texts; one in five is held back for calibration."""
    rows = [(t, y) for t, y in zip(texts, languages) if has_letter(t) and y is not None]
    names = sorted({y for _, y in rows})
    if not names:
        return None
    rng = np.random.default_rng(seed)
    x = [features(t) for t, _ in rows]
    y = np.array([names.index(v) for _, v in rows])
    order = rng.permutation(len(rows))
    held = order[:len(rows) // 5]
    fit = order[len(rows) // 5:]
    emb = rng.normal(0, 0.1, (BUCKETS, DIM))
    out = rng.normal(0, 0.1, (DIM, len(names)))
    bias = np.zeros(len(names))
    # classes weigh alike however many texts each has
    weight = 1.0 / np.maximum(np.bincount(y[fit], minlength=len(names)), 1)
    weight *= len(fit) / weight[y[fit]].sum() if len(fit) else 1.0
    steps, total = 0, max(EPOCHS * len(fit), 1)
    for _ in range(EPOCHS):
        for i in rng.permutation(fit):
            u, c = x[i]
            rate = RATE * (1 - steps / total) * weight[y[i]]
            steps += 1
            mean = c @ emb[u]
            g = _softmax(mean @ out + bias)
            g[y[i]] -= 1
            back = out @ g
            out -= rate * 0.1 * np.outer(mean, g)
            bias -= rate * 0.01 * g
            emb[u] -= rate * c[:, None] * back[None, :]
    table = (emb @ out).astype(np.float32)
    held = held if len(held) else fit
    z = np.array([c @ table[u] + bias for u, c in (x[i] for i in held)])
    temperature, threshold = _calibrate(z, y[held])
    return Model(names, table, bias, temperature, threshold)


def _calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """The temperature with the least log loss, and the lowest score from
    which on at least PRECISION of the predictions are right."""
    def loss(t):
        return -np.log(np.maximum(_softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean()
    t = min(np.geomspace(0.05, 20, 121), key=loss)
    p = _softmax(z / t)
    score, right = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(share >= PRECISION)
    return float(t), float(score[order][good[-1]]) if len(good) else 1.0


def predict(model: Model | None, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each whole text."""
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    rows = [i for i, t in enumerate(texts) if has_letter(t)]
    if model is None or not rows:
        return names, scores
    codes = [_codes(texts[i]) for i in rows]
    n = np.array([len(c) for c in codes])
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    flat, h = np.concatenate(codes), None
    z = np.zeros((len(rows), len(model.languages)))
    grams = np.zeros(len(rows))
    ends = starts + n
    for k in range(1, ORDERS + 1):
        if len(flat) < k:
            break
        h, b = _buckets(flat, k, h)
        s = model.table[b]
        for back in range(1, k):  # n-grams that run into the next text
            at = ends - back
            at = at[(at >= 0) & (at < len(s))]
            s[at] = 0
        first = np.minimum(starts, len(s) - 1)
        part = np.add.reduceat(s, first, axis=0, dtype=np.float64)
        z += np.where((starts < len(s))[:, None], part, 0)
        grams += np.maximum(n - k + 1, 0)
    p = _softmax((z / grams[:, None] + model.bias) / model.temperature)
    for i, best, v in zip(rows, p.argmax(axis=1), p.max(axis=1)):
        names[i], scores[i] = model.languages[best], v
    return names, scores


def fit(train_rows: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
        per_language: int = PER_LANGUAGE) -> Model | None:
    """Learn from at most about ``per_language`` texts of each language,
    chosen by a hash of ``key``. Only these reach the driver."""
    rows = train_rows.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    if not counts:
        return None
    unit = 1_000_000
    share = F.lit(0)
    for name, n in counts.items():
        share = F.when(F.col(lang) == name, min(unit, unit * per_language // n + 1)).otherwise(share)
    chosen = rows.filter(F.pmod(F.xxhash64(key), F.lit(unit)) < share)
    got = chosen.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l")).collect()
    got.sort(key=lambda r: (str(r.k), r.l, r.t))
    return train([r.t for r in got], [r.l for r in got])


def identify(df: DataFrame, model: Model | None, text: str = "text", lang_out: str = "lang_pred",
             score_out: str = "score", rejected_out: str = "rejected") -> DataFrame:
    """``df`` with the language, the calibrated score and whether it is
    rejected, in place of columns of these names."""
    df = df.drop(lang_out, score_out, rejected_out)
    names = df.columns

    def run(batches):
        for batch in batches:
            for lo, hi in chunks(batch, text, 1_000_000):
                part = batch.slice(lo, hi - lo)
                langs, scores = predict(model, part.column(text).to_pylist())
                low = scores < (model.threshold if model else 1.0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(langs), pa.array(scores), pa.array(low)],
                    names=[*names, lang_out, score_out, rejected_out])

    schema = StructType([*df.schema.fields, StructField(lang_out, StringType()),
                         StructField(score_out, DoubleType()),
                         StructField(rejected_out, BooleanType())])
    return df.mapInArrow(run, schema)
