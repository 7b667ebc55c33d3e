"""Substring dedup by recompression.

Word sequences are renamed in rounds: runs of one symbol become one symbol, then
the symbols are split into two classes by a hash and every neighbouring pair of
a first-class and a second-class symbol becomes one symbol. A name is a hash of
what it stands for, so the rounds name globally without any exchange: equal
substrings get equal symbols, except near their ends, where the neighbours
outside take part. For every symbol the span of words that it depends on is
kept, and inside a window only symbols whose span lies in the window are used.
Those are the same in every copy of the window, whatever stands around it.

1. Every window (``words`` consecutive words of a document) picks the smallest
   name among its symbols of the highest round that has one (a window without
   any names itself). The names, with all words they depend on, meet by name
   across documents: one narrow row per name and document.
2. Windows whose name no other document has are settled. The others are named
   themselves, by two independent 64-bit hashes of their words, and meet by that
   name; a window is removed in every document but the smallest that has it.
3. Each document marks the words of its removed windows.

Names that very many documents share send one row per batch to their partition
(``common.collapse``); partitions are sorted and streamed, so no name's rows are
held together.

Defined cases: null and empty texts have no words; documents with fewer words
than a window lose none; a window repeated inside one document does not remove
itself; rows that repeat a doc_id are one document, each judged by its own text;
a null doc_id takes no part and loses nothing; an empty table gives an empty
result. Only key and text are read, so extra columns do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, SpanHash, collapse, long_column, materialize, member, mix, shared_keys, shuffle_partitions, slabs, text_or_empty, word_spans

WINDOW = 13
_words, _words2 = SpanHash(301), SpanHash(302)  # bytes of a word
_names, _names2 = SpanHash(303), SpanHash(304)  # word names of a span
FLUSH = 1 << 20  # rows collapsed at a time


def _word_names(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(name, text number, start, end) of every word of a slab."""
    s, e, d = word_spans(buf, off)
    return _words.words(buf, s, e), d, s, e


def rounds_for(window: int) -> int:
    """Rounds after which a symbol still depends on fewer words than a window."""
    return max(1, int(np.log2(window)) - 1)


def compress_round(name, start, lo, hi, doc, begin, end, r):
    """One round: runs, then pairs. lo, hi: span of words a symbol depends on;
    begin, end: of each document, in words. A dependence on a document's edge
    reaches one word beyond it, so no window contains it."""
    n = len(name)
    inner = doc[1:] == doc[:-1]
    # a run is maximal, and a single symbol no run, because of its neighbours
    left = np.concatenate([[0], np.where(inner, lo[:-1], begin[doc[1:]] - 1)])
    left[0] = begin[doc[0]] - 1
    right = np.concatenate([np.where(inner, hi[1:], end[doc[:-1]] + 1), [end[doc[-1]] + 1]])
    first = np.flatnonzero(np.concatenate([[True], ~(inner & (name[1:] == name[:-1]))]))
    last = np.concatenate([first[1:], [n]]) - 1
    k = (last - first + 1).astype(U64)
    name, start, lo, hi, doc = np.where(k > 1, mix(name[first] * U64(3) + k + U64(r)), name[first]), start[first], left[first], right[last], doc[first]
    # pairs of a first-class and a second-class symbol cannot overlap
    second = (mix(name + U64(0xA24BAED4963EE407 * (r + 1) % 2**64)) >> U64(63)).astype(bool)
    n = len(name)
    inner = doc[1:] == doc[:-1]
    head = np.concatenate([inner & ~second[:-1] & second[1:], [False]])
    tail = np.concatenate([[False], head[:-1]])
    # a symbol that stays alone does so because of the neighbour it could have met
    left = np.concatenate([[begin[doc[0]] - 1], np.where(inner, lo[:-1], begin[doc[1:]] - 1)])
    right = np.concatenate([np.where(inner, hi[1:], end[doc[:-1]] + 1), [end[doc[-1]] + 1]])
    alone = ~head & ~tail
    lo = np.where(alone & second, left, lo)
    hi = np.where(alone & ~second, right, hi)
    after = np.concatenate([np.arange(1, n), [n - 1]])
    pair = mix((name ^ U64(0xD6E8FEB86659FD93)) * U64(5) + mix(name[after]) + U64(r))
    name = np.where(head, pair, name)
    hi = np.where(head, hi[after], hi)
    keep = ~tail
    return name[keep], start[keep], lo[keep], hi[keep], doc[keep]


def window_names(w: np.ndarray, d: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(start, name) of every window of a slab's words: the name is that of the
    symbol the window picks, hashed with all words the symbol depends on."""
    n = len(w)
    if n < window:
        return np.empty(0, np.int64), np.empty(0, U64)
    begin = np.searchsorted(d, np.arange(d[-1] + 1))
    end = np.searchsorted(d, np.arange(d[-1] + 1), "right")
    s = np.flatnonzero(d[: n - window + 1] == d[window - 1:])
    prefix = _names.prefix_of(w)
    symbols = (w, np.arange(n), np.arange(n), np.arange(1, n + 1), d)
    levels = []
    for r in range(rounds_for(window)):
        symbols = compress_round(*symbols, begin, end, r)
        levels.append(symbols)
    out = np.zeros(len(s), U64)
    todo = np.arange(len(s))
    for r, (name, start, lo, hi, _) in reversed(list(enumerate(levels))):
        if not len(todo):
            break
        at = s[todo]
        # lo and hi never decrease, so the usable symbols of a window are neighbours
        a = np.cumsum(np.bincount(lo + 1, minlength=n + 2))[at]  # symbols with lo < at
        z = np.cumsum(np.bincount(hi, minlength=n + 2))[at + window]  # symbols with hi <= at + window
        rank = mix(name)
        best = np.minimum(a, len(name) - 1)
        for k in range(1, int((z - a).max(initial=0))):
            other = np.minimum(a + k, len(name) - 1)
            best = np.where((a + k < z) & (rank[other] < rank[best]), other, best)
        some = z > a
        pick = best[some]
        key = _names.spans(prefix, lo[pick], hi[pick]) + mix(name[pick] + (start[pick] - lo[pick]).astype(U64)) + U64(r)
        out[todo[some]] = key
        todo = todo[~some]
    if len(todo):
        out[todo] = mix(_names.spans(prefix, s[todo], s[todo] + window) + U64(0x5851F42D4C957F2D))
    return s, out


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc"), text_or_empty(text).alias("text"))


def candidate_names(rows: DataFrame, window: int) -> DataFrame:
    """(key, doc, kind): the names that the windows of each document pick."""

    def run(batches):
        for b in batches:
            ids = long_column(b, "doc")
            keys, docs, held = [], [], 0
            for at, buf, off in slabs(b):
                w, d, _, _ = _word_names(buf, off)
                s, name = window_names(w, d, window)
                if len(s):
                    change = np.concatenate([[True], (name[1:] != name[:-1]) | (d[s[1:]] != d[s[:-1]])])
                    keys.append(name[change])
                    docs.append(ids[at.start + d[s[change]]])
                    held += len(keys[-1])
                if held > FLUSH:
                    yield _collapsed(keys, docs)
                    keys, docs, held = [], [], 0
            if held:
                yield _collapsed(keys, docs)

    return rows.mapInArrow(run, "key long, doc long, kind byte")


def _collapsed(keys, docs) -> pa.RecordBatch:
    k, d, kind = collapse(np.concatenate(keys).view(np.int64), np.concatenate(docs))
    return pa.record_batch([pa.array(k), pa.array(d), pa.array(kind)], names=["key", "doc", "kind"])


def named_windows(rows: DataFrame, window: int) -> DataFrame:
    """(h1, h2, doc): the windows whose picked name is in the row's ``keys``,
    named by two hashes. h2 is null where a smaller document of the batch has
    the window, so that nothing is left to decide."""

    def run(batches):
        for b in batches:
            ids = long_column(b, "doc")
            lists = b.column(b.schema.get_field_index("keys"))
            got, held = [], 0
            for at, buf, off in slabs(b):
                w, d, starts, ends = _word_names(buf, off)
                s, name = window_names(w, d, window)
                if not len(s):
                    continue
                s = s[member(name, d[s], lists.slice(at.start, at.stop - at.start))]
                second = _words2.words(buf, starts, ends)
                h1 = _names.spans(_names.prefix_of(w), s, s + window)
                h2 = _names2.spans(_names2.prefix_of(second), s, s + window)
                got.append((h1.view(np.int64), h2.view(np.int64), ids[at.start + d[s]]))
                held += len(s)
                if held > FLUSH:
                    yield settled(got)
                    got, held = [], 0
            if held:
                yield settled(got)

    def settled(got):
        h1, h2, doc = (np.concatenate(x) for x in zip(*got))
        order = np.lexsort((doc, h2, h1))
        h1, h2, doc = h1[order], h2[order], doc[order]
        same = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
        new = np.concatenate([[True], ~same | (doc[1:] != doc[:-1])])
        first = np.concatenate([[True], ~same])[new]
        return pa.record_batch([pa.array(h1[new]), pa.array(h2[new], mask=~first), pa.array(doc[new])], names=["h1", "h2", "doc"])

    return rows.mapInArrow(run, "h1 long, h2 long, doc long")


def later_copies(windows: DataFrame) -> DataFrame:
    """(doc, h1): windows that a smaller document has too."""
    n = shuffle_partitions(windows)
    met = windows.repartition(n, F.coalesce(F.when(F.col("h2").isNotNull(), F.col("h1")), F.col("doc"))).sortWithinPartitions("h1", "h2", "doc")

    def stream(batches):
        last, least = None, None
        for b in batches:
            done = np.asarray(b.column(1).is_null())
            h1, doc = b.column(0).to_numpy(), b.column(2).to_numpy()
            out_d, out_h = [doc[done]], [h1[done]]
            h1, doc, h2 = h1[~done], doc[~done], b.column(1).drop_null().to_numpy()
            if len(h1):
                first = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
                starts = np.flatnonzero(first)
                smallest = doc[starts].copy()
                if last == (h1[0], h2[0]):
                    smallest[0] = least
                last, least = (h1[-1], h2[-1]), smallest[-1]
                later = doc > np.repeat(smallest, np.diff(np.concatenate([starts, [len(h1)]])))
                out_d.append(doc[later])
                out_h.append(h1[later])
            yield pa.record_batch([pa.array(np.concatenate(out_d)), pa.array(np.concatenate(out_h))], names=["doc", "h1"])

    return met.mapInArrow(stream, "doc long, h1 long")


def removed_words(rows: DataFrame, window: int) -> DataFrame:
    """Per row of (doc, text, removed): the words that stay."""

    def run(batches):
        for b in batches:
            lists = b.column(b.schema.get_field_index("removed"))
            n_words, n_removed, digest = [], [], []
            for at, buf, off in slabs(b):
                w, d, s, e = _word_names(buf, off)
                prefix = _names.prefix_of(w)
                cut = np.searchsorted(d, np.arange(at.stop - at.start + 1))
                raw = buf.tobytes()
                for i, (x, y) in enumerate(zip(cut[:-1], cut[1:])):
                    words = raw[off[i]: off[i + 1]].split()
                    gone = lists[at.start + i]
                    out = 0
                    if gone.is_valid and y - x >= window:
                        p = np.arange(x, y - window + 1)
                        hit = np.flatnonzero(np.isin(_names.spans(prefix, p, p + window), gone.values.to_numpy().view(U64)))
                        edge = np.zeros(y - x + 1, np.int64)
                        edge[hit] += 1
                        np.add.at(edge, hit + window, -1)
                        stay = np.cumsum(edge)[:-1] == 0
                        out = len(words) - int(stay.sum())
                        words = [words[j] for j in np.flatnonzero(stay).tolist()]
                    n_words.append(y - x)
                    n_removed.append(out)
                    digest.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.record_batch([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string())], names=["doc", "n_words", "n_removed", "kept_sha256"])

    return rows.mapInArrow(run, "doc long, n_words long, n_removed long, kept_sha256 string")


def dedup(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) of every row: the words left
    after removing each one that is covered by a window which also starts in a
    document with a smaller key."""
    rows = _rows(docs, key, text)
    own = rows.filter("doc is not null")
    keys = shared_keys(candidate_names(own, window)).groupBy("doc").agg(F.collect_list("key").alias("keys"))
    keys = materialize(keys, "recompression-names")  # a document's own names: bounded by its text
    meant = own.join(keys.hint("shuffle_hash"), "doc")
    gone = materialize(later_copies(named_windows(meant, window)), "recompression-windows")
    gone = gone.groupBy("doc").agg(F.collect_set("h1").alias("removed"))
    out = rows.join(gone.hint("shuffle_hash"), "doc", "left").select("doc", "text", "removed")
    return removed_words(out, window).withColumnRenamed("doc", key)
