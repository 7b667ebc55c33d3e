"""Shared helpers of the corpus operators: materialised tables, numpy views
of Arrow text columns, and vectorised word hashing.

Words are ``[^\\x20\\x09-\\x0D]+`` over UTF-8 bytes everywhere; a null text has
no words. Hashes are 64-bit; where equality must be proved, two independent
ones are used (128 bits) or the texts are compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_path, scratch_path

CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Java class of the ASCII white space that separates words
SPACE = r"[\x20\x09-\x0D]"
WORDS_SPLIT = SPACE + "+"
WORDS = r"[^\x20\x09-\x0D]+"
U64 = np.uint64
LONG_WORD = 32  # bytes


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps start
    from files that survive the loss of any executor, and the shuffle files
    of the step are freed as soon as it ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        # snappy: zstd keeps native memory per open page until the next collection,
        # which adds up over many small files
        df.write.option("compression", "snappy").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by ``materialize`` that nothing reads any more."""
    drop_path(df.sparkSession, df._scratch)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def word_array(c) -> Column:
    """The words of a text column, natively (empty array for null)."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), WORDS_SPLIT), lambda w: w != "")


def word_count(c) -> Column:
    """Number of words, natively: runs of non-space, without an array of
    strings being kept."""
    return F.size(word_array(c)).cast("long")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before those that ``df`` has already."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def with_computed(docs: DataFrame, text: Column, compute: Callable[[pa.RecordBatch], pa.Array], kind: T.DataType, name: str) -> DataFrame:
    """``docs`` with one more column that ``compute`` makes of each Arrow batch
    (its column ``text`` is the given one). All other columns pass through."""
    cols = docs.columns
    inner = docs.select(*(F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(cols)), text.alias("text"))

    def run(batches):
        for b in batches:
            yield pa.record_batch([*b.columns[:-1], compute(b)], names=[*b.schema.names[:-1], "_new"])

    kinds = [T.StructField(f"_c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)]
    out = inner.mapInArrow(run, T.StructType([*kinds, T.StructField("_new", kind)]))
    return out.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(cols)), F.col("_new").alias(name))


def shuffle_partitions(df: DataFrame, least: int = 1) -> int:
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


# ---- Arrow text to numpy -------------------------------------------------

SLAB_BYTES = 1 << 20  # texts are worked through in slabs of about this size

_WS = np.zeros(256, bool)
_WS[[0x20, *range(0x09, 0x0E)]] = True


def slabs(batch: pa.RecordBatch, text: str = "text", limit: int = SLAB_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of consecutive rows of a batch: the rows' texts
    as one byte array and where each begins (one more offset than rows). A
    slab holds at least one whole text, and otherwise about ``limit`` bytes."""
    arr = batch.column(batch.schema.get_field_index(text))
    arr = pc.fill_null(arr.cast(pa.large_binary()), b"")
    if len(arr) == 0:
        return
    _, off, data = arr.buffers()
    off = np.frombuffer(off, np.int64)[arr.offset: arr.offset + len(arr) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    i = 0
    while i < len(arr):
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        j = min(j, len(arr))
        yield slice(i, j), data[off[i]: off[j]], off[i: j + 1] - off[i]
        i = j


def long_column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def word_spans(buf: np.ndarray, off: np.ndarray, space: np.ndarray = _WS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text number) of every word of a slab; ``space`` marks the
    bytes that are in no word."""
    n = len(buf)
    if n == 0:
        z = np.empty(0, np.int64)
        return z, z, z
    word = ~space[buf]
    first = np.empty(n, bool)
    first[0] = True
    np.logical_not(word[:-1], out=first[1:])
    cuts = off[1:-1]
    first[cuts[cuts < n]] = True
    starts = np.flatnonzero(word & first)
    last = np.empty(n, bool)
    last[-1] = True
    np.logical_not(word[1:], out=last[:-1])
    cuts = cuts[cuts > 0]
    last[cuts - 1] = True
    ends = np.flatnonzero(word & last) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that all bits depend on all bits."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


class SpanHash:
    """64-bit hashes of byte spans of a slab from prefix sums of a polynomial
    in an odd base modulo 2**64, over bytes mapped to random odd numbers."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 1 << 63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
        self.base = int(rng.integers(0, 1 << 62)) * 4 + 3
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = np.ones(1, U64)
        self.down = np.ones(1, U64)

    @staticmethod
    def _powers(old: np.ndarray, base: int, n: int) -> np.ndarray:
        while len(old) < n:
            step = U64(pow(base, len(old), 1 << 64))
            old = np.concatenate([old, old * step])
        return old

    def prefix(self, buf: np.ndarray) -> np.ndarray:
        """Prefix sums over bytes."""
        return self.prefix_of(self.table[buf])

    def prefix_of(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums over 64-bit names."""
        n = len(values) + 1
        self.up = self._powers(self.up, self.base, n)
        self.down = self._powers(self.down, self.inverse, n)
        out = np.zeros(n, U64)
        np.cumsum(values * self.up[: n - 1], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((prefix[ends] - prefix[starts]) * self.down[starts] + (ends - starts).astype(U64) * U64(0x9E3779B97F4A7C15))

    def words(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of words. Sums modulo 2**64 are alike for long sequences of a
        certain structure, whatever the base, so long words get XXH64."""
        if not len(starts):
            return np.empty(0, U64)
        out = self.spans(self.prefix(buf), starts, ends)
        for i in np.flatnonzero(ends - starts >= LONG_WORD):
            out[i] = xxhash.xxh64_intdigest(buf[starts[i]: ends[i]].tobytes(), self.base & 0xFFFFFFFF)
        return out


def hash_words(buf: np.ndarray, off: np.ndarray, hasher: SpanHash) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text number, start, end) of every word of a slab."""
    s, e, d = word_spans(buf, off)
    return (hasher.spans(hasher.prefix(buf), s, e) if len(s) else np.empty(0, U64)), d, s, e


# ---- names that several documents share ------------------------------------


def collapse(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, doc, kind) of a batch: kind 0 is a key of one document
    here, 1 the smallest of several documents with the key, 2 the others. Only
    kinds 0 and 1 need to meet the rows of other batches, so a key that is in
    very many documents sends one row a batch to its partition."""
    order = np.lexsort((docs, keys))
    k, d = keys[order], docs[order]
    if not len(k):
        return k, d, np.empty(0, np.int8)
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (d[1:] != d[:-1])])
    k, d = k[new], d[new]
    first = np.concatenate([[True], k[1:] != k[:-1]])
    last = np.concatenate([first[1:], [True]])
    return k, d, np.where(first & last, 0, np.where(first, 1, 2)).astype(np.int8)


def shared_keys(rows: DataFrame) -> DataFrame:
    """(key, doc) of the keys that two or more rows have, from rows (key, doc,
    kind) made by ``collapse``. One shuffle: rows meet by key, those already
    known to be shared are spread by document, and sorted partitions are
    streamed, so no key's rows are held together."""
    n = shuffle_partitions(rows)
    met = rows.repartition(n, F.when(F.col("kind") == 2, F.col("doc")).otherwise(F.col("key"))).sortWithinPartitions("key")

    def stream(batches):
        last, known, waiting = None, False, None  # last key; is it shared; the document waiting for a second one
        for b in batches:
            key, doc, kind = (b.column(i).to_numpy() for i in range(3))
            through = kind == 2
            out_k, out_d = [key[through]], [doc[through]]
            key, doc, kind = key[~through], doc[~through], kind[~through]
            if len(key):
                starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                sizes = np.diff(np.concatenate([starts, [len(key)]]))
                shared = (sizes > 1) | (np.maximum.reduceat(kind, starts) > 0)
                if last is not None and key[0] == last:
                    shared[0] = True
                    if waiting is not None:
                        out_k.append(np.array([last], np.int64))
                        out_d.append(np.array([waiting], np.int64))
                last, known = key[-1], bool(shared[-1])
                waiting = None if known else doc[-1]
                keep = np.repeat(shared, sizes)
                out_k.append(key[keep])
                out_d.append(doc[keep])
            yield pa.record_batch([pa.array(np.concatenate(out_k)), pa.array(np.concatenate(out_d))], names=["key", "doc"])

    return met.mapInArrow(stream, "key long, doc long")


def member(values: np.ndarray, rows: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Whether each (row, value) is in that row's list of an Arrow list column;
    by 64-bit hash of the pair, so a filter, not a proof."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).view(U64)
    sizes = np.nan_to_num(pc.list_value_length(lists).to_numpy(zero_copy_only=False), nan=0).astype(np.int64)
    own = np.repeat(np.arange(len(lists)), sizes).astype(U64)
    c = U64(0x9E3779B97F4A7C15)
    have = np.sort(mix(flat + own * c))
    want = mix(values + rows.astype(U64) * c)
    if not len(have):
        return np.zeros(len(want), bool)
    at = np.minimum(np.searchsorted(have, want), len(have) - 1)
    return have[at] == want


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
