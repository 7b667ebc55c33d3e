"""Benchmark decontamination: word-pair seeds counted in a window, then Smith-Waterman.

Words are compared in lower case without ASCII punctuation. A document has a
copy of a test item where local alignment (match +2, mismatch -1, gap -1 a word)
scores ``least`` of a perfect copy or more, and at least the worth of ``SHORT``
matching words (or of the whole item, if that is less), so that short items are
not found in chance phrases. The score is the best alignment over that of a
perfect copy; edited and paraphrased copies score less than 1 but far above chance.

Seeds lose no such passage. Let it score T = 2M - E with M matched words and E
edits. Of its M - 1 pairs of consecutive matched words at most E / 2 have two
edits or more between them, so T / 2 - 1 or more have none or one. In such a
pair the words are neighbours or one word apart, in the item and in the
document. All these pairs of an item (hashes of words i, i + 1 and of i, i + 2)
are looked up at all pairs of the documents, and the passage holds at least
T / 2 - 1 hits that begin at different words. Up to half of these are given up:
one pass over all documents counts the pairs, and as many item positions as
that, those with the most frequent pairs, are not looked up. The passage is at
most 3 words(item) - T words long, so every window of that length with enough
hits is aligned, as far as the passage can reach.

The test items are the query set: they are read in blocks of at most
``BLOCK_BYTES`` of text, each broadcast and run against all documents (a block
is a few thousand items; more items mean more blocks, not larger ones). No
candidate is dropped.

Defined cases: items without words match nothing; an item of one word is its own
seed; null and empty documents match nothing; a repeated item_id or doc_id
gives its best row once for each pair; a null doc_id is in no pair, but such a
row is dropped like any other; ties go to the earliest passage; empty tables give
an empty result. Extra columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, SpanHash, fresh, long_column, slabs, text_or_empty, with_computed, word_spans

SHORT = 6  # words
BLOCK_BYTES = 8 << 20
PIECE = 1 << 21  # hits, and cells of an alignment table, worked through at a time
MATCH, MISMATCH, GAP = 2, -1, -1
_hasher = SpanHash(202)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[[i for i in range(33, 127) if not chr(i).isalnum()]] = 32


def folded_words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hash, text number) of the folded words of a slab."""
    buf = _FOLD[buf]
    s, e, d = word_spans(buf, off)
    return (_hasher.spans(_hasher.prefix(buf), s, e) if len(s) else np.empty(0, U64)), d


def pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of pairs of words (of one word, if both are the same array)."""
    h = a * U64(0x9E3779B97F4A7C15)
    h ^= h >> U64(29)
    h = (h ^ b) * U64(0x9E3779B97F4A7C15)
    return h ^ (h >> U64(29))


class Items:
    """A block of test items: their words and the table of their seeds."""

    def __init__(self, ids: list, texts: list[bytes]):
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        w, d = folded_words(np.frombuffer(b"".join(texts), np.uint8), off)
        cut = np.searchsorted(d, np.arange(len(texts) + 1))
        self.ids = ids
        self.words = [w[a:b] for a, b in zip(cut[:-1], cut[1:])]
        self.lengths = np.diff(cut)
        alone = np.flatnonzero(self.lengths[d] == 1) if len(w) else np.empty(0, np.int64)
        self.steps = [0, 1, 2] if len(alone) else [1, 2]  # words from the first of a seed to the second
        rows = [(pairs(w[alone], w[alone]), alone)]
        for n in (1, 2):
            p = np.flatnonzero(d[: -n] == d[n:])
            rows.append((pairs(w[p], w[p + n]), p))
        h, p = (np.concatenate(c) for c in zip(*rows))
        self.index(h, d[p], p)

    def index(self, h: np.ndarray, item: np.ndarray, at: np.ndarray) -> None:
        order = np.lexsort((item, h))
        self.h, self.item, self.at = h[order], item[order], at[order]
        self.keys, self.first, self.count = np.unique(self.h, return_index=True, return_counts=True)
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[self.keys >> U64(42)] = True

    def hits(self, w: np.ndarray, d: np.ndarray):
        """(position in the slab, number of the seed) of all seeds of the block
        in a slab's words."""
        for n in self.steps:
            if len(w) <= n or not len(self.keys):
                continue
            h = pairs(w[: len(w) - n], w[n:])
            p = np.flatnonzero(self.maybe[h >> U64(42)])
            p = p[d[p] == d[p + n]]
            k = np.minimum(np.searchsorted(self.keys, h[p]), len(self.keys) - 1)
            ok = self.keys[k] == h[p]
            yield p[ok], k[ok]

    def keep_rarest(self, freq: np.ndarray, least: float) -> None:
        """Leave out seeds that occur nowhere and, of every item, as many of the
        positions with the most frequent seeds as its window can do without.
        ``freq``: occurrences of every seed."""
        perfect = MATCH * self.lengths
        self.least = np.ceil(np.maximum(least * perfect, np.minimum(perfect, MATCH * SHORT)) - 1e-9).astype(np.int64)
        self.reach = np.maximum(3 * self.lengths - self.least, 1)  # words of the longest passage
        need = np.maximum((self.least + 1) // 2 - 1, 1)
        spare = need // 2
        self.need = need - spare
        f = np.repeat(freq, self.count)
        there, row = np.unique(self.at, return_inverse=True)
        total = np.bincount(row, f, len(there))
        of = np.empty(len(there), np.int64)
        of[row] = self.item
        order = np.lexsort((-total, of))
        of = of[order]
        rank = np.arange(len(of)) - np.searchsorted(of, of)
        out = np.zeros(len(there), bool)
        out[order] = rank < spare[of]
        keep = (f > 0) & ~out[row]
        self.index(self.h[keep], self.item[keep], self.at[keep])


def align(item: np.ndarray, passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of ``item`` with each passage and the passage
    word it ends at. One row of the table per item word, all passages at once;
    gaps along a row come from a running maximum."""
    r = max(len(p) for p in passages)
    text = np.zeros((len(passages), r), U64)
    there = np.zeros((len(passages), r), bool)
    for i, p in enumerate(passages):
        text[i, : len(p)], there[i, : len(p)] = p, True
    slope = -GAP * np.arange(r + 1, dtype=np.int32)
    h = np.zeros((len(passages), r + 1), np.int32)
    best, end = np.zeros(len(passages), np.int32), np.zeros(len(passages), np.int64)
    for w in item:
        t = np.maximum(h + GAP, 0)
        t[:, 1:] = np.maximum(t[:, 1:], h[:, :-1] + np.where((text == w) & there, MATCH, MISMATCH))
        h = np.maximum.accumulate(t + slope, axis=1) - slope
        at = h.argmax(axis=1)
        top = h[np.arange(len(passages)), at]
        better = top > best
        best[better], end[better] = top[better], at[better]
    return best, end  # end: number of passage words up to and including the last one


def passages(items: Items, w: np.ndarray, d: np.ndarray):
    """(item, text number, first word, end) of all passages of a slab that may
    hold a copy of an item, by item; of bounded numbers of hits at a time."""
    got = list(items.hits(w, d))
    where, k = (np.concatenate(c) for c in zip(*got)) if got else (np.empty(0, np.int64),) * 2
    order = np.argsort(where, kind="stable")
    where, k = where[order], k[order]
    upto = np.concatenate([[0], np.cumsum(items.count[k])])
    heads = np.flatnonzero(np.diff(d[where], prepend=-1))  # pieces are whole texts
    edges, i = np.append(heads, len(where)), 0
    while i < len(heads):
        j = max(i + 1, int(np.searchsorted(upto[edges], upto[edges[i]] + PIECE, "right")) - 1)
        a, b = edges[i], edges[j]
        times = items.count[k[a:b]]
        p = np.repeat(where[a:b], times)
        step = np.arange(len(p)) - np.repeat(np.cumsum(times) - times, times)
        item = items.item[np.repeat(items.first[k[a:b]], times) + step]
        order = np.lexsort((p, item))
        p, item = p[order], item[order]
        new = np.ones(len(p), bool)
        new[1:] = (p[1:] != p[:-1]) | (item[1:] != item[:-1])
        p, item = p[new], item[new]
        last = np.arange(len(p)) + items.need[item] - 1
        ok = last < len(p)
        first, last = np.flatnonzero(ok), last[ok]
        reach = items.reach[item[first]]
        ok = (item[first] == item[last]) & (d[p[first]] == d[p[last]]) & (p[last] - p[first] < reach)
        first, last, reach = first[ok], last[ok], reach[ok]
        yield item[first], d[p[first]], p[last] - reach + 1, p[first] + reach
        i = j


def match_slab(items: Items, w: np.ndarray, d: np.ndarray):
    """(text number, item number, score, first word, last word) of the passages
    of a slab that align with an item well enough."""
    begin_of = np.searchsorted(d, np.arange(d[-1] + 2)) if len(d) else np.zeros(1, np.int64)
    out = []
    for item, text, lo, hi in passages(items, w, d):
        lo, hi = np.maximum(lo, begin_of[text]), np.minimum(hi, begin_of[text + 1])
        i = 0
        while i < len(item):  # by item, text and place already
            j = int(np.searchsorted(item, item[i], "right"))
            spans = []  # of one item: merged passages of the slab's texts
            for t, a, b in zip(text[i:j].tolist(), lo[i:j].tolist(), hi[i:j].tolist()):
                if spans and spans[-1][0] == t and a <= spans[-1][2]:
                    spans[-1][1] = min(spans[-1][1], a)
                    spans[-1][2] = max(spans[-1][2], b)
                else:
                    spans.append([t, a, b])
            out += matches(items, int(item[i]), w, begin_of, spans)
            i = j
    return out


def matches(items: Items, item: int, w: np.ndarray, begin_of: np.ndarray, spans: list) -> list:
    """The rows of ``match_slab`` for one item and its passages."""
    x, out, a = items.words[item], [], 0
    spans.sort(key=lambda s: s[2] - s[1])  # like lengths together: little padding
    while a < len(spans):
        z = a + 1
        while z < min(len(spans), a + 256) and (z + 1 - a) * (spans[z][2] - spans[z][1]) <= PIECE:
            z += 1
        best, end = align(x, [w[s[1]: s[2]] for s in spans[a:z]])
        for (t, l, _), b, e in zip(spans[a:z], best, end):
            if b >= items.least[item]:
                e = l + int(e)
                l = max(l, e - int(items.reach[item]))
                _, back = align(x[::-1], [w[l:e][::-1]])
                out.append((t, item, b / (MATCH * len(x)), e - int(back[0]) - int(begin_of[t]), e - 1 - int(begin_of[t])))
        a = z
    return out


def item_blocks(benchmark: DataFrame, key: str, text: str):
    """The test items in blocks of bounded size, by key."""
    ids, texts, size = [], [], 0
    for r in benchmark.select(key, F.lower(text_or_empty(text)).alias("text")).orderBy(key, "text").toLocalIterator():
        t = r["text"].encode()
        if texts and size + len(t) > BLOCK_BYTES:
            yield Items(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(r[0])
        texts.append(t)
        size += len(t)
    if texts:
        yield Items(ids, texts)


def seeded_blocks(rows: DataFrame, benchmark: DataFrame, item_key: str, text: str, least: float):
    """Broadcast blocks of test items with their seeds, chosen by how often
    ``rows`` (one column text) have them."""
    spark = rows.sparkSession
    for items in item_blocks(benchmark, item_key, text):
        shared = spark.sparkContext.broadcast(items)

        def count(batches, shared=shared):
            total = np.zeros(len(shared.value.keys), np.int64)
            for b in batches:
                for _, buf, off in slabs(b):
                    for _, k in shared.value.hits(*folded_words(buf, off)):
                        total += np.bincount(k, minlength=len(total))
            some = np.flatnonzero(total)
            yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["seed", "n"])

        # one row per seed of the block: bounded by BLOCK_BYTES
        table = rows.mapInArrow(count, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).toArrow()
        freq = np.zeros(len(items.keys), np.int64)
        freq[table["seed"].to_numpy()] = table["n"].to_numpy()
        items.keep_rarest(freq, least)
        yield spark.sparkContext.broadcast(items)


def find(docs: DataFrame, benchmark: DataFrame, least: float = 0.4, key: str = "doc_id", item_key: str = "item_id", text: str = "text") -> DataFrame:
    """(key, item_key, score, first_word, last_word): the best passage of every
    document for every test item it contains a copy of."""
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.lower(text_or_empty(text)).alias("text")).filter("doc is not null")
    kinds = "doc long, item long, score double, first_word long, last_word long"
    out = docs.sparkSession.createDataFrame([], kinds)
    for seeds in seeded_blocks(rows.select("text"), benchmark, item_key, text, least):

        def run(batches, seeds=seeds):
            for b in batches:
                ids = long_column(b, "doc")
                for at, buf, off in slabs(b):
                    w, d = folded_words(buf, off)
                    got = match_slab(seeds.value, w, d) if len(w) else []
                    yield pa.record_batch(
                        [
                            pa.array([ids[at.start + g[0]] for g in got], pa.int64()),
                            pa.array([seeds.value.ids[g[1]] for g in got], pa.int64()),
                            pa.array([float(g[2]) for g in got], pa.float64()),
                            pa.array([g[3] for g in got], pa.int64()),
                            pa.array([g[4] for g in got], pa.int64()),
                        ],
                        names=["doc", "item", "score", "first_word", "last_word"],
                    )

        out = out.unionAll(rows.mapInArrow(run, kinds))
    # the same pair may come from several passages of a document, or from repeated rows
    best = out.groupBy("doc", "item").agg(F.min(F.struct((-F.col("score")).alias("s"), "first_word", "last_word")).alias("b"))
    return best.select(F.col("doc").alias(key), F.col("item").alias(item_key), (-F.col("b.s")).alias("score"), "b.first_word", "b.last_word")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.4, item_key: str = "item_id", text: str = "text") -> DataFrame:
    """The rows without a copy of any test item, all columns. Every row is
    judged where it is; nothing is joined or moved."""
    lower = F.lower(text_or_empty(text))
    out = docs
    (name,) = fresh(docs, "_hit")
    for seeds in seeded_blocks(docs.select(lower.alias("text")), benchmark, item_key, text, least):

        def compute(batch: pa.RecordBatch, seeds=seeds) -> pa.Array:
            hit = np.zeros(batch.num_rows, bool)
            for at, buf, off in slabs(batch):
                w, d = folded_words(buf, off)
                for g in match_slab(seeds.value, w, d) if len(w) else ():
                    hit[at.start + g[0]] = True
            return pa.array(hit)

        out = with_computed(out, lower, compute, T.BooleanType(), name).filter(~F.col(name)).drop(name)
    return out
