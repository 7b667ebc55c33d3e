"""SimHash near-duplicates by vantage-point trees.

Every text gets a 64-bit fingerprint of its word shingles. Equal fingerprints
are one node. The distinct fingerprints are partitioned by Hamming distance: a
vantage-point tree, fitted on a bounded sample (``SAMPLE`` fingerprints, however
many there are), routes every fingerprint to its shard; a fingerprint within
``radius`` of a node's boundary also goes across it, so that by the triangle
inequality every pair within the radius meets in at least one shard. Inside a
shard the tree goes on, and leaves are joined exactly.

Only links of a spanning forest leave a shard (fewer than its fingerprints, so
a dense ball of near copies gives no pairwise output), and components come from
label propagation over those links with written tables between rounds.

A leaf is joined without comparing all its pairs: two fingerprints differ in at
most two bits exactly if they share one of their 65 neighbours at distance 0 or
1, so a sort of neighbours links them (radius 2); small leaves are compared
directly.

Defined cases: a null or empty text has fingerprint zero and links like any
other; a text with fewer words than a shingle is one shingle of its whole word
sequence; repeated rows share a node; a null key names no component, and where no
row of a component has a key its component_id is null; an empty table gives an
empty result. Extra columns, whatever their names, do not matter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, fresh, materialize, text_or_empty, with_computed

SAMPLE = 20_000  # fingerprints the routing tree is fitted on, at most
SHARD = 20_000  # fingerprints aimed at per shard, at most
LEAST_SHARDS = 64  # aimed at for small inputs, so that all cores have work
DIRECT = 512  # leaves up to this size compare their pairs directly
U64 = np.uint64


# ---- fingerprints ----------------------------------------------------------


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Bit i is 1 if it is set in over half the shingles' XXH64 hashes."""
    w = text.lower().split()  # on bytes: A-Z only, and ASCII white space only
    if not w:
        return 0
    grams = map(b" ".join, zip(*(w[i:] for i in range(shingle)))) if len(w) >= shingle else [b" ".join(w)]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(g, seed) for g in grams), U64, max(1, len(w) - shingle + 1))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[i: i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(U64)[0])


def batch_fingerprints(batch: pa.RecordBatch, shingle: int) -> np.ndarray:
    texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
    return np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), U64, batch.num_rows)


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fp): the fingerprint of every whole text, as a signed long."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array(batch_fingerprints(b, shingle).view(np.int64))], names=[key, "fp"])

    return docs.select(key, text_or_empty(text).alias("text")).mapInArrow(run, f"`{key}` {kind}, fp long")


# ---- the tree --------------------------------------------------------------


def distance(a: np.ndarray, v) -> np.ndarray:
    return np.bitwise_count(a ^ U64(v))


def split(x: np.ndarray, radius: int, rng) -> tuple[int, int] | None:
    """A vantage point and boundary that halve ``x`` with few fingerprints near
    the boundary; None if no tried point separates anything usefully."""
    best, found = 2.2, None  # copies per fingerprint, and the larger side's share; a worse split costs more than it saves
    for v in rng.choice(x, min(6, len(x)), replace=False):
        n = np.bincount(distance(x, v), minlength=65)
        upto = np.cumsum(n)
        for mu in {int(np.searchsorted(upto, len(x) * q)) for q in (0.35, 0.5, 0.65)}:
            left, guests = upto[mu], n[max(0, mu - radius + 1): mu + 1].sum()
            big = max(left, len(x) - left + guests) / len(x)
            if 0 < left < len(x) and big < 0.85 and (cost := (len(x) + guests) / len(x) + big) < best:
                best, found = cost, (int(v), mu)
    return found


def grow(sample: np.ndarray, leaf: int, radius: int, rng) -> list:
    """Nested [vantage, boundary, inner, outer] nodes; a leaf is a number."""
    leaves = 0

    def node(x):
        nonlocal leaves
        cut = split(x, radius, rng) if len(x) > leaf else None
        if cut is None:
            leaves += 1
            return leaves - 1
        inner, outer = sides(x, *cut, radius)
        return [*cut, node(x[inner]), node(x[outer])]

    return [node(sample), leaves]


def sides(x: np.ndarray, v: int, mu: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that go inside and outside the boundary. Those inside that may have
    a partner outside, which by the triangle inequality lies no further than
    ``radius`` beyond, go both ways; so each pair within the radius meets."""
    d = distance(x, v)
    return np.flatnonzero(d <= mu), np.flatnonzero(d > mu - radius)


def route(tree, x: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, shard) of every fingerprint, rows near boundaries several times."""
    rows, shards = [], []
    todo = [(tree, np.arange(len(x)))]
    while todo:
        node, at = todo.pop()
        if not len(at):
            continue
        if isinstance(node, int):
            rows.append(at)
            shards.append(np.full(len(at), node, np.int32))
            continue
        inner, outer = sides(x[at], node[0], node[1], radius)
        todo += [(node[2], at[inner]), (node[3], at[outer])]
    return (np.concatenate(rows), np.concatenate(shards)) if rows else (np.empty(0, np.int64), np.empty(0, np.int32))


class Forest:
    """Union-find over row numbers; keeps the links that joined two trees."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.links: list[tuple[int, int]] = []

    def find(self, a: int) -> int:
        up = self.up
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    def join(self, pairs) -> None:
        for a, b in pairs:
            ra, rb = self.find(a), self.find(b)
            if ra != rb:
                self.up[max(ra, rb)] = min(ra, rb)
                self.links.append((a, b))


def join_leaf(x: np.ndarray, at: np.ndarray, radius: int, forest: Forest) -> None:
    """Link the rows ``at`` of ``x`` that differ in at most ``radius`` bits."""
    y = x[at]
    if len(at) <= DIRECT or radius != 2:
        step = max(1, (1 << 22) // max(1, len(at)))
        for i in range(0, len(at), step):
            a, b = np.nonzero(np.bitwise_count(y[i: i + step, None] ^ y[None, :]) <= radius)
            keep = a + i < b
            forest.join(zip(at[a[keep] + i].tolist(), at[b[keep]].tolist()))
        return
    flips = np.concatenate([np.zeros(1, U64), U64(1) << np.arange(64, dtype=U64)])
    parts = max(1, len(at) // 50_000)  # neighbours are handled in this many parts of hash space, to bound memory
    for part in range(parts):
        keys, own = [], []
        for f in flips:
            k = y ^ f
            pick = np.flatnonzero((k * U64(0x9E3779B97F4A7C15) >> U64(32)) % U64(parts) == U64(part)) if parts > 1 else np.arange(len(y))
            keys.append(k[pick])
            own.append(at[pick])
        keys, own = np.concatenate(keys), np.concatenate(own)
        order = np.argsort(keys, kind="stable")
        keys, own = keys[order], own[order]
        same = np.flatnonzero(keys[1:] == keys[:-1])
        forest.join(zip(own[same].tolist(), own[same + 1].tolist()))


def link_shard(x: np.ndarray, radius: int, seed: int = 0) -> list[tuple[int, int]]:
    """Links (row, row) of a spanning forest of the rows within ``radius``."""
    rng, forest = np.random.default_rng(seed), Forest(len(x))
    todo = [np.arange(len(x))]
    while todo:
        at = todo.pop()
        cut = split(x[at], radius, rng) if len(at) > DIRECT else None
        if cut is None:
            join_leaf(x, at, radius, forest)
        else:
            todo += [at[s] for s in sides(x[at], *cut, radius)]
    return forest.links


# ---- components ------------------------------------------------------------


def link(nodes: DataFrame, radius: int = 2, seed: int = 3) -> DataFrame:
    """(a, b): links that span the components of the distinct fingerprints
    ``nodes`` (one column fp) at ``radius``."""
    n = nodes.count()
    sample = nodes.sample(min(1.0, 1.2 * SAMPLE / max(n, 1)), seed).orderBy(F.xxhash64("fp")).limit(SAMPLE)
    got = np.array(sorted(r["fp"] for r in sample.collect()), np.int64).view(U64)
    leaf = max(16, int(len(got) * min(SHARD, n / LEAST_SHARDS) / max(n, 1)))
    tree, shards = grow(got, leaf, radius, np.random.default_rng(seed)) if len(got) else (0, 1)

    def place(batches):
        for b in batches:
            x = b.column(0).to_numpy()
            rows, shard = route(tree, x.view(U64), radius)
            yield pa.record_batch([pa.array(x[rows]), pa.array(shard)], names=["fp", "shard"])

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.sort(pdf["fp"].to_numpy())
        pairs = np.array(link_shard(x.view(U64), radius), np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": x[pairs[:, 0]], "b": x[pairs[:, 1]]})

    placed = nodes.select("fp").mapInArrow(place, "fp long, shard int")
    # a shard holds about SHARD fingerprints of 8 bytes and is worked on in one task
    return placed.groupBy("shard").applyInPandas(join, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable over ``links`` (a, b), for all
    linked nodes. Rounds of large-star and small-star; every round is written
    to the shared folder, so a lost executor costs at most that round. Each
    round keeps at most one link per node pair, and stars halve distances, so
    rounds grow with the logarithm of a component's width."""
    e = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "links")
    while True:
        # large star: every larger neighbour of u is linked to the smallest node around u
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: u and its smaller neighbours are linked to the smallest of them
        large = large.filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        nxt = materialize(small.filter("u != v").distinct(), "links")
        n, kept = nxt.count(), nxt.join(e, ["u", "v"], "left_semi").count()
        done = n == kept == e.count()
        discard(e)
        e = nxt
        if done:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def classes(docs: DataFrame, shingle: int, radius: int, text: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(key, fp) of every row, and (fp, root, component_id) of every
    fingerprint: component_id is the smallest key reachable."""
    fps = materialize(fingerprints(docs, shingle, text, key), "simhash")
    nodes = materialize(fps.groupBy("fp").agg(F.min(key).alias("first")), "simhash-nodes")
    roots = components(link(nodes, radius))
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return fps, named.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fingerprint, component_id): fingerprints link at ``radius`` or
    fewer differing bits; a component is named by its smallest key."""
    fps, named = classes(docs, shingle, radius, text, key)
    return fps.join(named, "fp").select(key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = 3, radius: int = 2, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each component stays, with all columns: one with the smallest
    key, or, where no row of the component has a key, any one of its rows."""
    fps, named = classes(docs, shingle, radius, text, key)
    named = materialize(named, "simhash-classes")
    kept, fp = fresh(docs, "_kept", "_fp")
    first = named.filter(F.col("component_id").isNotNull()).select(F.col("component_id").alias(kept)).distinct()
    own = docs.join(first.hint("shuffle_hash"), F.col(key) == F.col(kept), "left_semi").dropDuplicates([key])
    nameless = with_computed(docs.filter(F.col(key).isNull()), text_or_empty(text), lambda b: pa.array(batch_fingerprints(b, shingle).view(np.int64)), T.LongType(), fp)
    (node,) = fresh(nameless, "_node")
    alone = named.filter(F.col("component_id").isNull()).select(F.col("fp").alias(node), F.col("root").alias(kept))
    nameless = nameless.join(alone, F.col(fp) == F.col(node)).dropDuplicates([kept]).select(*docs.columns)
    return own.unionByName(nameless)
