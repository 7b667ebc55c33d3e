"""Quality classifier: naive Bayes support vectors.

Features are indicators of n-grams: byte trigrams, words, pairs of words, and
"some word twice in a row", hashed into ``BUCKETS``. Each indicator is scaled by its log-count ratio between
the classes, rows are scaled to unit length, and a linear L2 hinge-loss model is
fitted by dual coordinate descent. The score of a text is the logistic of its
margin.

The model is fitted on a bounded sample of labelled rows (``MAX_ROWS`` of them,
chosen by hash, and no more than ``MAX_FEATURES`` indicators in all, as
documented parameters). Scoring covers every whole text, in Arrow batches, with
one weight array of fixed size (``BUCKETS`` numbers, 8 MB) broadcast.

Defined cases: null and empty texts have no indicators and get the bias alone;
equal texts get equal scores; a label that is null is no label, and a doc_id
labelled twice takes its larger label; without labels of both classes every
text scores 0.5; an empty table gives an empty result. Only the key and the
text are read, so extra columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, SpanHash, fresh, hash_words, slabs, text_or_empty, with_computed

BUCKETS = 1 << 20
MAX_ROWS = 6_000
MAX_FEATURES = 8_000_000
TWICE = 12_345  # bucket of "a word twice in a row"
_hasher = SpanHash(101)


def indicators(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of the distinct n-gram indicators of a slab, in
    order of text number."""
    keys = []
    n = len(off) - 1
    if len(buf) >= 3:
        b = buf.astype(np.uint32)
        code = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
        text = np.repeat(np.arange(n), np.diff(off))
        inside = text[:-2] == text[2:]
        h = (code * np.uint32(2654435761)) >> np.uint32(12)
        # two rounds keep the sort small: trigrams repeat a lot inside a text
        keys.append((text[:-2].astype(U64) << U64(20) | h)[inside])
    w, d, _, _ = hash_words(buf, off, _hasher)
    if len(w):
        keys.append(d.astype(U64) << U64(20) | (w >> U64(44)))
        pair = (w[:-1] * U64(0x9E3779B97F4A7C15) + w[1:]) * U64(0xC2B2AE3D27D4EB4F)
        same = d[:-1] == d[1:]
        keys.append((d[:-1].astype(U64) << U64(20) | pair >> U64(44))[same])
        # a pair of one word with itself, whichever word it is, is an indicator of its own
        keys.append(d[:-1][same & (w[:-1] == w[1:])].astype(U64) << U64(20) | U64(TWICE))
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    k = np.sort(np.concatenate(keys))
    k = k[np.concatenate([[True], k[1:] != k[:-1]])]
    return (k >> U64(20)).astype(np.int64), (k & U64(BUCKETS - 1)).astype(np.int64)


def log_ratios(rows: list[np.ndarray], y: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    """Log of the ratio of smoothed indicator frequencies, class 1 to class 0."""
    pos, neg = np.full(BUCKETS, alpha), np.full(BUCKETS, alpha)
    for x, label in zip(rows, y):
        (pos if label > 0 else neg)[x] += 1
    return np.log((pos / pos.sum()) / (neg / neg.sum()))


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, c: np.ndarray, epochs: int = 12, seed: int = 5) -> np.ndarray:
    """Weights of min |w|^2/2 + sum c_i max(0, 1 - y_i w.x_i) by coordinate
    descent on the dual, one variable per row; the last bucket index is the bias."""
    w = np.zeros(BUCKETS + 1)
    a = np.zeros(len(y))
    q = np.array([float(v @ v) + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(y)):
            x, v = rows[i], values[i]
            g = y[i] * (w[x] @ v + w[BUCKETS]) - 1.0
            new = min(max(a[i] - g / q[i], 0.0), c[i])
            if new != a[i]:
                step = (new - a[i]) * y[i]
                w[x] += step * v
                w[BUCKETS] += step
                worst = max(worst, abs(new - a[i]))
                a[i] = new
        if worst < 1e-4:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "label", key: str = "doc_id", max_rows: int = MAX_ROWS, c: float = 5.0) -> np.ndarray | None:
    """Weights from the labelled rows of ``docs``, or None without both classes.
    The sample is the ``max_rows`` labelled keys with the smallest hash; it is
    chosen among keys alone, so no text moves but the sampled ones."""

    def run(batches):
        for b in batches:
            for rows, buf, off in slabs(b, "text"):
                d, x = indicators(buf, off)
                cut = np.searchsorted(d, np.arange(rows.stop - rows.start + 1))
                out = [x[i:j].astype(np.int32).tobytes() for i, j in zip(cut[:-1], cut[1:])]
                part = b.slice(rows.start, rows.stop - rows.start)
                yield pa.record_batch([part.column(0), part.column(1), pa.array(out, pa.binary())], names=["h", "y", "x"])

    have = docs.select(F.col(key).alias("_k")).distinct()
    known = labels.filter(F.col(label).isNotNull()).select(F.col(key).alias("_k"), F.col(label).cast("int").alias("y"))
    some = known.join(have, "_k", "left_semi").withColumn("h", F.xxhash64(F.col("_k").cast("string"))).orderBy("h", "_k").limit(max_rows)
    texts = docs.select(F.col(key).alias("_d"), text_or_empty(text).alias("text"))
    # at most max_rows rows of three numbers
    rows = texts.join(F.broadcast(some), F.col("_d") == F.col("_k")).select("h", "y", "text")
    flat, ends, y = np.empty(MAX_FEATURES, np.int32), [0], []
    for r in rows.mapInArrow(run, "h long, y int, x binary").orderBy("h", "x").toLocalIterator():
        x = np.frombuffer(r["x"], np.int32)
        if ends[-1] + len(x) > MAX_FEATURES:
            break
        flat[ends[-1]: ends[-1] + len(x)] = x
        ends.append(ends[-1] + len(x))
        y.append(1 if r["y"] > 0 else -1)
    y = np.array(y)
    if len(set(y.tolist())) < 2:
        return None
    x = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
    ratio = log_ratios(x, y)
    scaled = ratio[flat[: ends[-1]]].astype(np.float32)
    values = [scaled[a:b] for a, b in zip(ends[:-1], ends[1:])]
    for v in values:
        v /= max(1e-9, float(np.sqrt(v @ v)))
    w = dual_descent(x, values, y, np.full(len(y), c))
    return np.concatenate([w, ratio])


def score(docs: DataFrame, model: np.ndarray | None, text: str = "text", key: str = "doc_id", name: str = "score") -> DataFrame:
    """(key, score) of every whole text."""
    return with_score(docs.select(key, text), model, text, name).select(key, name)


def keep(docs: DataFrame, model: np.ndarray | None, least: float = 0.5, text: str = "text") -> DataFrame:
    """The rows that score ``least`` or more, all columns, in one pass."""
    (name,) = fresh(docs, "_score")
    return with_score(docs, model, text, name).filter(F.col(name) >= least).drop(name)


def with_score(docs: DataFrame, model: np.ndarray | None, text: str, name: str) -> DataFrame:
    """``docs`` and the score of each row's whole text."""
    if model is None:
        return docs.withColumn(name, F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(model.astype(np.float32))  # 2 * BUCKETS + 1 numbers, whatever the data

    def compute(batch: pa.RecordBatch) -> pa.Array:
        m = shared.value
        weight, bias, ratio = m[:BUCKETS], float(m[BUCKETS]), m[BUCKETS + 1:]
        both, square, out = weight * ratio, ratio * ratio, [np.empty(0)]
        for at, buf, off in slabs(batch):
            d, x = indicators(buf, off)
            n = at.stop - at.start
            norm = np.sqrt(np.maximum(np.bincount(d, square[x], n), 1e-18))
            margin = np.bincount(d, both[x], n) / norm + bias
            out.append(1.0 / (1.0 + np.exp(-np.clip(3.0 * margin, -40, 40))))
        return pa.array(np.concatenate(out))

    return with_computed(docs, text_or_empty(text), compute, T.DoubleType(), name)


def one_label(labels: DataFrame, label: str = "quality", key: str = "doc_id") -> DataFrame:
    """(key, label): one row per labelled key, its largest label."""
    return labels.filter(F.col(label).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("label"))
