"""Target-distribution importance resampling: documents that look like a target
corpus are drawn more often.

Every text becomes a bag of hashed word and word-pair features. A bucket's gain
is the log ratio of its smoothed share in the target and in the corpus; a
document's weight is the floored mean gain of its features, read from one array
of gains per task. Adding seeded Gumbel noise to the weight and keeping the
highest scores draws documents without replacement in proportion to their
weights.

The cut is found without sorting the corpus: scores are written once, and exact
count jobs over that table bisect the score, then the keys that break ties. Only
the drawn rows are partitioned by range and sorted, which gives their ranks.

What reaches the driver is the bucket counts (``BUCKETS`` numbers, whatever the
data) and one row of counts per bisection job.

Defined cases: a null or empty text has no words, no features and weight 0. A
null key is hashed as an empty one and comes last among ties. Repeated rows
count each and get ranks of their own, in no stated order among rows that are
alike in score, key and number of features. An empty target or corpus counts as
zero features. Extra columns are passed through, whatever their names; the new
columns get underscores before names that are taken already.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, materialize, shuffle_partitions, slabs, text_or_empty, with_computed, word_spans

BUCKETS = 10_000
SEED = 7
PROBES = 31  # thresholds counted by one bisection job
LONG_WORD = 64  # bytes; the rest of a longer word is hashed on its own

#: bytes between words: all of ASCII but digits and letters
_GAP = np.zeros(256, bool)
_GAP[:128] = True
_GAP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _crc_steps() -> np.ndarray:
    """What one byte does to a CRC-32 register."""
    r = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        r = np.where(r & 1, (r >> 1) ^ np.uint32(0xEDB88320), r >> 1)
    return r.astype(np.uint32)


_STEPS = _crc_steps()
_FULL = np.uint32(0xFFFFFFFF)


def _crc_bytes(register: np.ndarray, found: np.ndarray) -> np.ndarray:
    return _STEPS[(register ^ found) & 255] ^ (register >> 8)


def crc_spans(register: np.ndarray, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 registers after the bytes of each span, all spans a byte at a time."""
    out, size = register.copy(), ends - starts
    live = np.flatnonzero(size > 0)
    for j in range(LONG_WORD):
        if not len(live):
            return out
        out[live] = _crc_bytes(out[live], buf[starts[live] + j])
        live = live[size[live] > j + 1]
    for i in live:
        out[i] = zlib.crc32(buf[starts[i] + LONG_WORD: ends[i]].tobytes(), int(out[i] ^ _FULL)) ^ 0xFFFFFFFF
    return out


def feature_buckets(buf: np.ndarray, off: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words per text, bucket of each feature, its text) of a slab."""
    buf = _LOWER[buf]
    starts, ends, text = word_spans(buf, off, _GAP)
    one = crc_spans(np.full(len(starts), _FULL), buf, starts, ends)
    pair = np.flatnonzero(text[1:] == text[:-1])
    two = crc_spans(_crc_bytes(one[pair], np.uint32(0x20)), buf, starts[pair + 1], ends[pair + 1])
    found = (np.concatenate([one, two]) ^ _FULL) % np.uint32(buckets)
    return np.bincount(text, minlength=len(off) - 1), found, np.concatenate([text, text[pair]])


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket, over all texts: summed per task, then by bucket."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, buf, off in slabs(b):
                total += np.bincount(feature_buckets(buf, off, buckets)[1], minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.record_batch([pa.array(hit), pa.array(total[hit])], names=["bucket", "n"])

    parts = df.select(text_or_empty(text).alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    n = len(corpus)
    all_s, all_t = int(corpus.sum()) + n, int(target.sum()) + n
    ratios = (((t + 1.0) * all_s) / ((s + 1.0) * all_t) for s, t in zip(corpus.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def gumbel(key: Column, seed: int = SEED) -> Column:
    """Thousandths of seeded Gumbel noise, rounded down, from a key alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def score(docs: DataFrame, target: DataFrame, seed: int = SEED, buckets: int = BUCKETS, text: str = "text", key: str = "doc_id", target_text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_features``, ``weight`` and ``score``."""
    gains = bucket_gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    shared = docs.sparkSession.sparkContext.broadcast(gains)  # 8 bytes a bucket

    def compute(batch):
        gains, out = shared.value, []
        for _, buf, off in slabs(batch):
            words, found, of = feature_buckets(buf, off, buckets)
            n = np.bincount(of, minlength=len(words))
            total = np.zeros(len(words), np.int64)
            order = np.argsort(of, kind="stable")
            if len(order):
                at = np.flatnonzero(np.diff(of[order], prepend=-1))
                total[of[order][at]] = np.add.reduceat(gains[found[order]], at)
            out.append((words, n, np.floor_divide(total, np.maximum(n, 1))))
        cols = [np.concatenate(c) if out else np.empty(0, np.int64) for c in (zip(*out) if out else [()] * 3)]
        return pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in cols], ["n_words", "n_features", "weight"])

    kind = T.StructType([T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")])
    held, *names = fresh(docs, "_found", "n_words", "n_features", "weight", "score")
    out = with_computed(docs, text_or_empty(text), compute, kind, held)
    found = F.col(held)
    return out.select(
        *(F.col(f"`{c}`") for c in docs.columns),
        *(found[f].alias(name) for f, name in zip(("n_words", "n_features", "weight"), names)),
        (found["weight"] + gumbel(F.col(key), seed)).alias(names[3]),
    )


def _last_of(rows: DataFrame, keys: Sequence[Column], want: int) -> list[int]:
    """The keys of the last of the first ``want`` rows in ascending order of
    integer ``keys``; later keys are left out where the cut lies between two
    values of the earlier ones. Every step is one exact count job that tests
    ``PROBES`` thresholds."""
    cut: list[int] = []
    for key in keys:
        lo, hi = rows.agg(F.min(key), F.max(key)).first()
        while lo < hi:
            probes = sorted({lo + (hi - lo) * i // (PROBES + 1) for i in range(PROBES + 1)})
            counts = rows.agg(*(F.count_if(key <= F.lit(p)) for p in probes)).first()
            enough = next((i for i, c in enumerate(counts) if c >= want), len(probes))
            lo, hi = (probes[enough - 1] + 1 if enough else lo), (probes[enough] if enough < len(probes) else hi)
        cut.append(lo)
        below, tied = rows.agg(F.count_if(key < F.lit(lo)), F.count_if(key == F.lit(lo))).first()
        want -= below
        if want == tied:
            break
        rows = rows.filter(key == F.lit(lo))
    return cut


def _not_after(keys: Sequence[Column], cut: Sequence[int]) -> Column:
    """Whether a row's keys are at or before the cut, in lexical order."""
    out = F.lit(True)
    for key, value in reversed(list(zip(keys, cut))):
        out = (key < F.lit(value)) | ((key == F.lit(value)) & out)
    return out


def ranked(scored: DataFrame, percent: int, eligible: Column, by: str = "score", key: str = "doc_id", features: str = "n_features") -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3... over the ``percent`` of the eligible
    rows with the highest scores (rounded down), ties to the smaller key; null
    for all others. The key must be an integer column."""
    cols = scored.columns
    flag, row, part, at, before, rank = fresh(scored, "_eligible", "_row", "_part", "_at", "_before", "rank")
    table = materialize(scored.withColumns({flag: F.coalesce(eligible, F.lit(False)), row: F.monotonically_increasing_id()}), "importance-scores")
    pool = table.filter(F.col(flag))
    want = percent * pool.count() // 100
    if want == 0:
        return table.select(*(F.col(f"`{c}`") for c in cols), F.lit(None).cast("long").alias(rank))
    k = F.col(key).cast("long")
    keys = [-F.col(by), k.isNull().cast("long"), F.coalesce(k, F.lit(0)), F.col(features), F.col(row)]
    drawn = F.col(flag) & _not_after(keys, _last_of(pool, keys, want))

    n = shuffle_partitions(scored)
    dealt = table.filter(drawn).repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn(part, F.spark_partition_id())
    names = [f"c{i}" for i in range(len(dealt.columns))]

    def number(batches):
        i = 0
        for b in batches:
            yield pa.record_batch([*b.columns, pa.array(np.arange(i, i + b.num_rows))], names=[*names, "at"])
            i += b.num_rows

    kinds = T.StructType([*(T.StructField(c, f.dataType) for c, f in zip(names, dealt.schema.fields)), T.StructField("at", T.LongType())])
    rows = dealt.toDF(*names).mapInArrow(number, kinds).toDF(*dealt.columns, at)
    rows = materialize(rows, "importance-drawn")  # the ranges stay as they are now
    sizes = dict(map(tuple, rows.groupBy(part).count().collect()))  # one row a partition
    starts, total = [], 0
    for p in sorted(sizes):
        starts.append((p, total))
        total += sizes[p]
    starts = F.broadcast(scored.sparkSession.createDataFrame(starts, T.StructType([T.StructField(part, T.IntegerType()), T.StructField(before, T.LongType())])))
    rows = rows.join(starts, part).select(*(F.col(f"`{c}`") for c in cols), (F.col(before) + F.col(at) + 1).alias(rank))
    rest = table.filter(~drawn).select(*(F.col(f"`{c}`") for c in cols), F.lit(None).cast("long").alias(rank))
    return rows.unionByName(rest)


def draw(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, **options) -> DataFrame:
    """The drawn documents, with all their columns, and their ``rank``."""
    scored = score(docs, target, **options)
    words, features, _, by = scored.columns[len(docs.columns):]
    out = ranked(scored, percent, F.col(words) >= min_words, by, options.get("key", "doc_id"), features)
    rank = out.columns[-1]
    return out.filter(F.col(rank).isNotNull()).select(*(F.col(f"`{c}`") for c in docs.columns), F.col(rank))
