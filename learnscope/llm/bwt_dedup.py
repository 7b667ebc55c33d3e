"""Substring dedup on suffix arrays: threshold-bounded interval expansion.

Strings of ``length`` bytes that occur in several documents are found on
Burrows-Wheeler transforms. The corpus is cut so that all copies of a string
come to one block:

1. Every position's string picks an anchor, the byte 8-gram with the smallest
   hash inside it (leftmost if tied), and a side, by where the anchor stands in
   it. All strings with one anchor and side contain ``length - half`` or so
   bytes from the anchor to that side; the hash of those bytes is the strings'
   key. Keys meet across documents, one narrow row per key and document, and
   keys of a single document are settled.
2. For the others, the stretch of text that holds a key's strings goes to the
   key's block. Equal stretches are one; where a key has one stretch only, its
   strings are all equal. The rest of the block is concatenated, its transform
   built, and breadth-first backward extension from the empty string sets the
   common-prefix values of neighbouring suffixes in increasing order. It stops
   at ``length``: suffixes not separated by then share that many bytes.
3. A string is removed in every document but the smallest that has it; each
   document merges its removed stretches.

Blocks are bounded by about ``BLOCK`` bytes of stretches: a key with more (a
phrase that many documents hold between different neighbours) is not put in a
block; its strings meet in a second shuffle by all their bytes. A stretch
that very many documents share is sent once per batch.

Defined cases: null and empty texts have no bytes; texts shorter than ``length``
lose none; a string repeated inside one document does not remove itself; rows
that repeat a doc_id are one document, each judged by its own text; a null doc_id
takes no part and loses nothing; an empty table gives an empty result. Only key
and text are read, so extra columns do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, SpanHash, collapse, long_column, materialize, member, mix, shared_keys, shuffle_partitions, slabs, text_or_empty

LENGTH, GRAM = 50, 8
BLOCK = 1 << 20
FLUSH = 1 << 20  # rows collapsed at a time
SEPARATOR = 0xFF  # never a byte of UTF-8
_bytes = SpanHash(401)


def anchored(buf: np.ndarray, off: np.ndarray, length: int = LENGTH):
    """Stretches of a slab: (text number, first start, last start, key, hash).
    The strings that start from first to last share an anchor and a side."""
    n, empty = len(buf), np.empty(0, np.int64)
    if n < length:
        return empty, empty, empty, empty.astype(U64), empty.astype(U64)
    prefix = _bytes.prefix(buf)
    down = _bytes.down
    gram = mix((prefix[GRAM:] - prefix[:-GRAM]) * down[: n - GRAM + 1])
    # the smallest hash wins, then the smaller position
    x = (gram & U64(0xFFFFFFFF00000000)) | np.arange(n - GRAM + 1, dtype=U64)
    width, span = length - GRAM + 1, 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    if width > span:
        x = np.minimum(x[: len(x) - (width - span)], x[width - span:])
    inside = np.ones(n - length + 1, bool)
    for c in off[1:-1].tolist():
        inside[max(0, c - length + 1): c] = False
    s = np.flatnonzero(inside)
    if not len(s):
        return empty, empty, empty, empty.astype(U64), empty.astype(U64)
    anchor = (x[s] & U64(0xFFFFFFFF)).astype(np.int64)
    half = (length - GRAM) // 2
    left = anchor - s >= half
    cut = np.flatnonzero((anchor[1:] != anchor[:-1]) | (left[1:] != left[:-1]) | (s[1:] != s[:-1] + 1)) + 1
    a, z = s[np.concatenate([[0], cut])], s[np.concatenate([cut, [len(s)]]) - 1]
    at = np.concatenate([[0], cut])
    p, side = anchor[at], left[at]
    lo = np.where(side, p - half, p)
    hi = np.where(side, p + GRAM, p + length - half + 1)
    key = mix(_bytes.spans(prefix, lo, hi) + side.astype(U64))
    text = np.searchsorted(off, a, "right") - 1
    return text, a, z, key, _bytes.spans(prefix, a, z + length)


def candidate_keys(rows: DataFrame, length: int) -> DataFrame:
    """(key, doc, kind): the keys of each document's strings."""

    def run(batches):
        for b in batches:
            ids = long_column(b, "doc")
            keys, docs, held = [], [], 0
            for at, buf, off in slabs(b):
                t, _, _, key, _ = anchored(buf, off, length)
                keys.append(key)
                docs.append(ids[at.start + t])
                held += len(key)
                if held > FLUSH:
                    yield done(keys, docs)
                    keys, docs, held = [], [], 0
            if held:
                yield done(keys, docs)

    def done(keys, docs):
        k, d, kind = collapse(np.concatenate(keys).view(np.int64), np.concatenate(docs))
        return pa.record_batch([pa.array(k), pa.array(d), pa.array(kind)], names=["key", "doc", "kind"])

    return rows.mapInArrow(run, "key long, doc long, kind byte")


def stretches(rows: DataFrame, length: int) -> DataFrame:
    """(key, bytes, doc, version, start, strings): the stretches of text whose
    key is in the row's ``keys``. bytes is null where a smaller document of the
    batch has the same stretch, so that all its strings are removed."""
    names = ["key", "bytes", "doc", "version", "start", "strings"]

    def run(batches):
        for b in batches:
            ids, versions = long_column(b, "doc"), long_column(b, "version")
            lists = b.column(b.schema.get_field_index("keys"))
            got, held = [], 0
            for at, buf, off in slabs(b):
                t, a, z, key, whole = anchored(buf, off, length)
                if not len(t):
                    continue
                m = member(key, t, lists.slice(at.start, at.stop - at.start))
                t, a, z, key, whole = t[m], a[m], z[m], key[m], whole[m]
                size = z - a + length
                pick = np.repeat(a - np.cumsum(size) + size, size) + np.arange(size.sum())
                got.append((key.view(np.int64), whole, ids[at.start + t], versions[at.start + t], a - off[t], z - a + 1, size, buf[pick]))
                held += int(size.sum())
                if held > 16 * FLUSH:
                    yield from done(got)
                    got, held = [], 0
            if held:
                yield from done(got)

    def done(got):
        key, whole, doc, version, start, strings, size, data = (np.concatenate(x) for x in zip(*got))
        order = np.lexsort((doc, whole, key))
        k, h, d = key[order], whole[order], doc[order]
        first = np.concatenate([[True], (k[1:] != k[:-1]) | (h[1:] != h[:-1])])
        smallest = np.repeat(d[first], np.diff(np.concatenate([np.flatnonzero(first), [len(d)]])))
        later = np.zeros(len(d), bool)
        later[order] = d > smallest
        part = [x[later] for x in (doc, version, start, strings)]
        n = len(part[0])
        yield pa.record_batch([pa.array(np.zeros(n, np.int64)), pa.nulls(n, pa.binary()), *(pa.array(x) for x in part)], names=names)
        off = np.concatenate([[0], np.cumsum(size)])
        keep = np.flatnonzero(~later)
        size = size[keep]
        ends = np.concatenate([[0], np.cumsum(size)])
        data = data[np.repeat(off[keep] - ends[:-1], size) + np.arange(ends[-1])]
        text = pa.Array.from_buffers(pa.binary(), len(keep), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])
        yield pa.record_batch([pa.array(key[keep]), text, *(pa.array(x[keep]) for x in (doc, version, start, strings))], names=names)

    return rows.mapInArrow(run, "key long, bytes binary, doc long, version long, start long, strings long")


def common_prefix_classes(text: np.ndarray, length: int) -> np.ndarray:
    """A number for every position of ``text`` that is equal for positions with
    the same next ``length`` bytes (as far as those hold no separator). ``text``
    ends in a separator and ``length`` more of them.

    The transform is taken in the order of the first ``length`` bytes. Intervals
    of suffixes that start with one string are extended to the left, level by
    level; the end of a new interval at level l separates two suffixes that share
    l bytes. An interval whose end was set before is not followed further."""
    n = len(text) - length
    view = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, length)[:n]).view(f"S{length}").ravel()
    suffix = np.argsort(view, kind="stable")
    del view
    bwt = text[suffix - 1]
    lf = np.empty(n, np.int64)
    lf[np.argsort(bwt, kind="stable")] = np.arange(n)
    split = np.zeros(n + 1, bool)
    split[0] = split[n] = True
    lb, rb = np.array([0]), np.array([n])
    for _ in range(length):
        if not len(lb):
            break
        size = rb - lb
        own = np.repeat(np.arange(len(lb)), size)
        rows = np.repeat(lb - np.cumsum(size) + size, size) + np.arange(size.sum())
        sym = bwt[rows]
        inside = sym != SEPARATOR  # no string holds a separator
        to = lf[rows[inside]]
        order = np.argsort(to)
        to, own, sym = to[order], own[inside][order], sym[inside][order]
        if not len(to):
            break
        cut = np.flatnonzero((to[1:] != to[:-1] + 1) | (own[1:] != own[:-1]) | (sym[1:] != sym[:-1])) + 1
        lb, rb = to[np.concatenate([[0], cut])], to[np.concatenate([cut, [len(to)]]) - 1] + 1
        new = ~split[rb]
        lb, rb = lb[new], rb[new]
        split[rb] = True
    out = np.empty(n, np.int64)
    out[suffix] = np.cumsum(split[:n])
    return out


def block_removals(key, texts: list[bytes], doc, start, length: int):
    """(row, first start, last start) of the removed strings of a block's rows."""
    number: dict[tuple[int, bytes], int] = {}
    own = np.fromiter((number.setdefault(x, len(number)) for x in zip(key.tolist(), texts)), np.int64, len(texts))
    distinct = [x[1] for x in number]
    keys = np.array([x[0] for x in number], np.int64)
    least = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(least, own, doc)
    strings = np.array([len(x) for x in distinct]) - length + 1
    later = np.flatnonzero(doc > least[own])
    out = [(later, start[later], start[later] + strings[own[later]] - 1)]
    _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
    several = np.flatnonzero(count[inverse] > 1)
    if len(several):
        parts = [distinct[i] for i in several.tolist()]
        sep = bytes([SEPARATOR])
        text = np.frombuffer(sep.join(parts) + sep * (length + 1), np.uint8)
        classes = common_prefix_classes(text, length)
        m = strings[several]
        begin = np.concatenate([[0], np.cumsum([len(x) + 1 for x in parts])])[:-1]
        of = np.repeat(np.arange(len(several)), m)
        step = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        cls = classes[begin[of] + step]
        smallest = np.full(cls.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(smallest, cls, least[several][of])
        gone = smallest[cls] < least[several][of]
        # runs of removed strings of each stretch, for the rows of its smallest document
        g = np.flatnonzero(gone)
        if len(g):
            cut = np.flatnonzero((g[1:] != g[:-1] + 1) | (of[g[1:]] != of[g[:-1]])) + 1
            a, z = g[np.concatenate([[0], cut])], g[np.concatenate([cut, [len(g)]]) - 1]
            stretch = several[of[a]]
            rows = np.flatnonzero(doc == least[own])
            order = np.argsort(own[rows], kind="stable")
            rows = rows[order]
            lo, hi = np.searchsorted(own[rows], stretch), np.searchsorted(own[rows], stretch, "right")
            times = hi - lo
            pick = rows[np.repeat(lo - np.cumsum(times) + times, times) + np.arange(times.sum())]
            out.append((pick, start[pick] + np.repeat(step[a], times), start[pick] + np.repeat(step[z], times)))
    return tuple(np.concatenate(x) for x in zip(*out))


def removals(parts: DataFrame, length: int, limit: int = BLOCK) -> DataFrame:
    """(doc, version, first, last, bytes): starts of the strings to remove, and,
    with their ``bytes``, the stretches of keys too large for a block (see ``settled``)."""
    n = shuffle_partitions(parts)
    met = parts.repartition(n, F.when(F.col("bytes").isNull(), F.col("doc")).otherwise(F.col("key"))).sortWithinPartitions("key")

    def run(batches):
        held, size, large = [], 0, None  # rows of the next block, their bytes, the key that is passed on
        for b in batches:
            b = pa.Table.from_batches([b])
            done = b.filter(b["bytes"].is_null())
            if done.num_rows:
                first = done["start"].to_numpy()
                yield out(done["doc"].to_numpy(), done["version"].to_numpy(), first, first + done["strings"].to_numpy() - 1)
            b = b.filter(b["bytes"].is_valid())
            while b.num_rows:
                key = b["key"].to_numpy()
                if large is not None:
                    same = int(np.searchsorted(key, large, "right"))
                    if same:
                        yield passed(b.slice(0, same))
                        b = b.slice(same)
                    large = large if same == len(key) else None
                elif size >= limit:
                    # a block is closed where the key changes; a key that fills one alone is passed on
                    t = pa.concat_tables(held)
                    last = t["key"][-1].as_py()
                    cut = int(np.searchsorted(t["key"].to_numpy(), last)) if key[0] == last else t.num_rows
                    if cut:
                        yield block(t.slice(0, cut))
                    t = t.slice(cut)
                    held, size = [t], int(pc.sum(pc.binary_length(t["bytes"])).as_py() or 0)
                    if size >= limit:
                        yield passed(t)
                        held, size, large = [], 0, last
                else:
                    ends = np.cumsum(pc.binary_length(b["bytes"]).to_numpy())
                    take = min(int(np.searchsorted(ends, limit - size)) + 1, len(key))
                    held.append(b.slice(0, take))
                    size += int(ends[take - 1])
                    b = b.slice(take)
        if size:
            yield block(pa.concat_tables(held))

    def block(t):
        doc, version, start = (t[c].to_numpy() for c in ("doc", "version", "start"))
        row, first, last = block_removals(t["key"].to_numpy(), t["bytes"].to_pylist(), doc, start, length)
        return out(doc[row], version[row], first, last)

    def passed(t):
        start = t["start"].to_numpy()
        return out(t["doc"].to_numpy(), t["version"].to_numpy(), start, start + t["strings"].to_numpy() - 1, t["bytes"].combine_chunks())

    def out(doc, version, first, last, data=None):
        data = pa.nulls(len(doc), pa.binary()) if data is None else data
        return pa.record_batch([*(pa.array(x) for x in (doc, version, first, last)), data], names=["doc", "version", "first", "last", "bytes"])

    return met.mapInArrow(run, "doc long, version long, first long, last long, bytes binary")


def settled(found: DataFrame, length: int) -> DataFrame:
    """(doc, version, first, last): the result of ``removals`` with the stretches
    of large keys settled string by string: their strings meet by all their
    bytes, in as many partitions as there are."""
    rows = found.filter("bytes is not null").select("doc", "version", "first", "bytes", F.explode(F.sequence(F.lit(0), (F.col("last") - F.col("first")).cast("int"))).alias("i"))
    strings = rows.select("doc", "version", (F.col("first") + F.col("i")).alias("first"), F.substring("bytes", F.col("i") + 1, F.lit(length)).alias("s"))
    least = strings.groupBy("s").agg(F.min("doc").alias("least"))
    gone = strings.join(least, "s").filter("doc > least").select("doc", "version", "first", F.col("first").alias("last"))
    return found.filter("bytes is null").drop("bytes").unionByName(gone)


def kept_bytes(rows: DataFrame, length: int) -> DataFrame:
    """Per row of (doc, text, removed): the bytes that stay."""

    def run(batches):
        for b in batches:
            lists = b.column(b.schema.get_field_index("removed"))
            size, lost, runs, digest = [], [], [], []
            for at, buf, off in slabs(b):
                for i in range(at.stop - at.start):
                    t = buf[off[i]: off[i + 1]]
                    gone = lists[at.start + i]
                    n_lost = n_runs = 0
                    if gone.is_valid:
                        v = gone.values
                        edge = np.zeros(len(t) + 1, np.int64)
                        np.add.at(edge, v.field(0).to_numpy(), 1)
                        np.add.at(edge, v.field(1).to_numpy() + length, -1)
                        out = np.cumsum(edge)[:-1] > 0
                        n_lost = int(out.sum())
                        n_runs = int(out[0]) + int((out[1:] & ~out[:-1]).sum())
                        t = t[~out]
                    size.append(int(off[i + 1] - off[i]))
                    lost.append(n_lost)
                    runs.append(n_runs)
                    digest.append(hashlib.sha256(t.tobytes()).hexdigest())
            yield pa.record_batch(
                [b.column(0), *(pa.array(x, pa.int64()) for x in (size, lost, runs)), pa.array(digest, pa.string())],
                names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return rows.mapInArrow(run, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def whole_copies(own: DataFrame, length: int) -> DataFrame:
    """(doc, version, first, last): texts that a smaller document has in full.
    All their strings go, and what they would add to the search the smaller
    document adds too."""
    t = own.select("doc", "version", F.octet_length("text").cast("long").alias("n"), F.md5("text").alias("m")).filter(F.col("n") >= length)
    least = t.groupBy("m").agg(F.min("doc").alias("least"))
    return t.join(least, "m").filter("doc > least").select("doc", "version", F.lit(0).cast("long").alias("first"), (F.col("n") - length).alias("last")).distinct()


def dedup(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256) of every row: the bytes
    left after removing each one that is covered by a string of ``length`` bytes
    which also starts in a document with a smaller key."""
    rows = docs.select(F.col(key).cast("long").alias("doc"), text_or_empty(text).alias("text"))
    # tells texts apart that one doc_id has
    rows = rows.withColumn("version", F.xxhash64("text"))
    own = rows.filter("doc is not null")
    copies = materialize(whole_copies(own, length), "bwt-copies")
    keys = shared_keys(candidate_keys(own.select("doc", "text"), length)).groupBy("doc").agg(F.collect_list("key").alias("keys"))
    done = copies.groupBy("doc").agg(F.collect_set("version").alias("done"))
    keys = materialize(keys.join(done, "doc", "left"), "bwt-keys")  # a document's own keys: bounded by its text
    meant = own.join(keys.hint("shuffle_hash"), "doc").filter("done is null or not array_contains(done, version)")
    meant = meant.select("doc", "text", "version", "keys")
    gone = settled(materialize(removals(stretches(meant, length), length, block), "bwt-removals"), length).unionByName(copies)
    gone = gone.groupBy("doc", "version").agg(F.collect_list(F.struct("first", "last")).alias("removed"))
    out = rows.join(gone.hint("shuffle_hash"), ["doc", "version"], "left").select("doc", "text", "removed")
    return kept_bytes(out, length).withColumnRenamed("doc", key)
