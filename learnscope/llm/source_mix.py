"""Mixing sources to target weights by a min-cost flow over membership patterns.

Documents are aggregated by the set of sources they belong to (their pattern).
A small flow network routes token capacity from patterns to source quotas: a
pattern offers its tokens once at no cost, a second time at cost 1, and so on
(convex), so repetition is used only where a quota needs it. Inside a pattern,
every document is taken as often as the flow repeats the whole pattern; the
rest is filled in a seeded order of the documents.

The only data that reaches the driver is one row per pattern, and their number
is checked (``MAX_PATTERNS``). The seeded order is cut at the quota without
sorting a source in one task: token sums per hash cell, in two levels of
4,096 cells, find the one cell in which the quota ends, and only that cell (one
sixteen-millionth of a source) is ordered row by row.

Defined cases: null or empty texts have size 0 and take 0. A null source is a
source of its own, last in order. Documents without any source have no quota
and are not taken. Repeated rows count each. Ties in the seeded order fall by
doc_id, then by size. An empty table gives an empty mix. The document in which
a quota ends is taken in part (its first words), so that every source meets its
quota to the word. Extra columns are ignored.
"""

from __future__ import annotations

from collections import deque
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize

MAX_PATTERNS = 100_000
CYCLE = (5, 2, 1)


def water_fill(sizes: list[int], weights: list[int], total: Fraction, most: int) -> list[Fraction]:
    """Shares of ``total`` by weight, none above ``most`` times its size; what a
    capped source leaves is shared again by weight until none is above."""
    target = [Fraction(0)] * len(sizes)
    free = set(range(len(sizes)))
    left = Fraction(total)
    while free:
        w = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] > most * sizes[i] * w]
        if not over:
            for i in free:
                target[i] = left * weights[i] / w
            break
        for i in over:
            target[i] = Fraction(most * sizes[i])
        left -= sum(target[i] for i in over)
        free.difference_update(over)
    return target


def push_flow(to: list[int], cap: list[int], out: list[list[int]], start: int, end: int) -> None:
    """Raise the flow from ``start`` to ``end`` to its maximum, by blocking flows
    over the nodes' distances. Edge e goes to ``to[e]`` with ``cap[e]`` left, its
    reverse is ``e ^ 1``, ``out`` lists the edges of each node."""
    while True:
        level = [-1] * len(out)
        level[start] = 0
        queue = deque([start])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if cap[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[end] < 0:
            return
        tried, path, a = [0] * len(out), [], start
        while True:
            if a == end:
                room = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= room
                    cap[e ^ 1] += room
                full = next(i for i, e in enumerate(path) if not cap[e])
                a = to[path[full] ^ 1]
                del path[full:]
                continue
            edges, i = out[a], tried[a]
            while i < len(edges) and not (cap[edges[i]] and level[to[edges[i]]] == level[a] + 1):
                i += 1
            tried[a] = i
            if i < len(edges):
                path.append(edges[i])
                a = to[edges[i]]
            elif path:
                a = to[path.pop() ^ 1]
                tried[a] += 1
            else:
                break


def min_cost_flow(supply: list[int], members: list[list[int]], quota: list[int], most: int) -> list[list[int]]:
    """Flow from each pattern to each of its sources: quotas are met as far as
    they can be, at the least total repetition cost (the r-th use of a pattern's
    tokens costs r - 1).

    Only the uses cost anything, so the cost of a path is that of the use it
    starts with: one maximum flow per cost level, with one more use of every
    pattern open at each, gives the same as cheapest paths one by one."""
    p_n, s_n = len(supply), len(quota)
    start, end = p_n + s_n, p_n + s_n + 1
    to: list[int] = []
    cap: list[int] = []
    out: list[list[int]] = [[] for _ in range(end + 1)]

    def edge(a: int, b: int, room: int) -> int:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to.extend((b, a))
        cap.extend((room, 0))
        return len(to) - 2

    uses = [edge(start, p, 0) for p in range(p_n)]
    at = [[edge(p, p_n + s, most * supply[p]) for s in own] for p, own in enumerate(members)]
    for s, q in enumerate(quota):
        edge(p_n + s, end, q)
    for _ in range(most):
        for p, e in enumerate(uses):
            cap[e] += supply[p]
        push_flow(to, cap, out, start, end)
    return [[cap[e ^ 1] for e in own] for own in at]


def by_code_point(sources) -> list:
    """Source names by code point, null last."""
    return sorted(sources, key=lambda s: (s is None, s or ""))


def mix(docs: DataFrame, share: Fraction = Fraction(3, 2), most: int = 2, weights: dict | None = None, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """``docs`` has (doc_id, size long, sources array<string>). Returns the mix,
    (doc_id, size, sources, taken), and per source (source, source_size, weight,
    target, quota, routed). Weights go 5, 2, 1, 5, ... by code point unless given."""
    spark = docs.sparkSession
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    # code points order as UTF-8 bytes do, and array_sort puts nulls last
    rows = materialize(
        docs.select(
            "doc_id",
            F.coalesce("size", F.lit(0)).cast("long").alias("size"),
            F.array_sort(F.array_distinct(F.coalesce("sources", F.array().cast("array<string>")))).alias("sources"),
            key.alias("h"),
        ),
        "mix-sizes",
    )
    found = rows.groupBy("sources").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns; merge rare ones before mixing")
    found.sort(key=lambda r: [(s is None, s or "") for s in r["sources"]])
    names = by_code_point({s for r in found for s in r["sources"]})
    number = {s: i for i, s in enumerate(names)}
    members = [[number[s] for s in r["sources"]] for r in found]
    supply = [r["size"] for r in found]
    sizes = [0] * len(names)
    for own, size in zip(members, supply):
        for s in own:
            sizes[s] += size
    weight = [CYCLE[i % len(CYCLE)] if weights is None else weights[s] for i, s in enumerate(names)]
    target = water_fill(sizes, weight, share * sum(supply), most)
    quota = [int(t + Fraction(1, 2)) for t in target]
    flow = min_cost_flow(supply, members, quota, most)
    routed = [0] * len(names)
    for own, fl in zip(members, flow):
        for s, x in zip(own, fl):
            routed[s] += x
    plan = [(r["sources"], sum(fl) // r["size"] if r["size"] else 0, sum(fl) % r["size"] if r["size"] else 0) for r, fl in zip(found, flow)]
    plan = spark.createDataFrame(plan, "sources array<string>, copies long, rest long")
    table = spark.createDataFrame(
        [(s, sizes[i], weight[i], float(target[i]), quota[i], routed[i]) for i, s in enumerate(names)],
        "source string, source_size long, weight long, target double, quota long, routed long",
    )
    return fill(rows, plan), table


def fill(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Take ``copies`` of every document of a pattern and ``rest`` more tokens
    in the order of the hash."""
    rows = rows.join(F.broadcast(plan), "sources")  # one row per pattern, at most MAX_PATTERNS
    b1, b2 = F.substring("h", 1, 3), F.substring("h", 4, 3)

    def last_cell(df: DataFrame, cell) -> DataFrame:
        """Per pattern, the cell in which ``rest`` ends and the rest at its start."""
        sums = df.groupBy("sources", cell.alias("cell")).agg(F.sum("size").alias("size"), F.first("rest").alias("rest"))
        upto = W.partitionBy("sources").orderBy("cell").rowsBetween(W.unboundedPreceding, 0)
        sums = sums.withColumn("upto", F.sum("size").over(upto))
        return sums.filter((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("size") < F.col("rest"))).select(
            "sources", "cell", (F.col("rest") - F.col("upto") + F.col("size")).alias("rest")
        )

    c1 = last_cell(rows.filter("rest > 0"), b1).withColumnRenamed("cell", "c1")
    inside = rows.drop("rest").withColumn("c1", b1).join(F.broadcast(c1), ["sources", "c1"])  # one row per pattern
    c2 = last_cell(inside, b2).withColumnRenamed("cell", "c2")
    cut = c1.drop("rest").join(c2, "sources")
    marked = rows.drop("rest").join(F.broadcast(cut), "sources", "left")  # one row per pattern
    here, last = F.substring("h", 1, 6), F.concat("c1", "c2")
    whole = marked.filter(F.col("c1").isNull() | (here != last)).withColumn("extra", F.when(here < last, F.col("size")).otherwise(F.lit(0)))
    w = W.partitionBy("sources").orderBy("h", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(w), F.lit(0))
    part = marked.filter(here == last).withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - before)))
    return whole.unionByName(part).select("doc_id", "size", "sources", (F.col("copies") * F.col("size") + F.coalesce("extra", F.lit(0))).cast("long").alias("taken"))
