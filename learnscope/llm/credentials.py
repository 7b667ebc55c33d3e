"""Secret scans by multipart credential linking.

Base spans are certain by their form: a secret word assigned a value, an access
key identifier, a long hexadecimal run. Weak parts say little alone: a user or
client id, a short password value, an unlabelled token of mixed characters, an
endpoint. A weak part is reported only where its scope holds what it needs to be
part of a credential:

* an identifier needs a secret, a secret needs an identifier,
* an endpoint needs both.

Two spans share a scope if no blank line lies between them (both are in one
block) and no more than ``REACH`` code points do.

One pass over the texts finds all parts; they are written with their documents'
row numbers, without the texts. Scopes are then joined to parts as intervals on
Spark: time and size of the join are linear in the parts, as each block is cut
into cells of ``REACH`` code points and a cell keeps, for each role, the first
start and the last end only. As a scope is wider than a cell, these two decide
exactly whether any part of a cell lies in the scope.

Defined cases: a null or empty text has no spans. Repeated rows are scanned and
returned each, by row, never by key. Very long texts are scanned whole; a
document's spans are returned together. An empty table gives an empty result.
Extra columns are ignored by ``scan`` (which returns the key and the spans) and
The result has the key and the spans, whatever other columns there are. Offsets
are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, materialize, text_or_empty, with_computed

REACH = 200  # code points between two spans of a scope, at most
BASE = ("assign", "access", "hex")
WEAK = ("id", "key", "endpoint")  # kinds of weak parts
KINDS = (*BASE, *WEAK)

# ---- base spans -------------------------------------------------------------


def _either_case(pattern: str) -> str:
    return re.sub(r"[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", pattern)


_VALUE = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ASSIGN = re.compile("(" + _either_case("password|passwd|secret|token|api_?key") + ")" + _VALUE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")  # a run of 16 or more is found from its start, as by [0-9a-f]+


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end() - m.start(2) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    return out + [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]


# ---- weak parts -------------------------------------------------------------

_ID = re.compile(r"(?<![A-Za-z0-9])" + _either_case("user|username|user_?id|login|account|client_?id|access_?key_?id|key_?id") + r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9@+/_.-]{3,}""")
_SHORT = re.compile(r"(?<![A-Za-z])" + "(?:" + _either_case("password|passwd|pwd|pass|secret|token|api_?key|auth") + ")" + _VALUE)
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}")
_URL = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s\"'<>]+")
_HOST = re.compile(r"(?<![A-Za-z0-9])" + "(?:" + _either_case("host|hostname|endpoint|server|base_?url|region") + r""")["']?\x20*[:=]\x20*["']?[A-Za-z0-9:/_.-]{3,}""")
_MIXED = (re.compile(r"[A-Z]"), re.compile(r"[a-z]"), re.compile(r"[0-9]"))
_BLANK = re.compile(r"\n[\x20\x09-\x0D]*\n")


def weak_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Parts by form alone, some of which may lie in others or in base spans."""
    if ":" in text or "=" in text:
        yield from (("id", m.start(), m.end()) for m in _ID.finditer(text))
        yield from (("key", m.start(), m.end()) for m in _SHORT.finditer(text) if m.end() - m.start(1) >= 4)
        yield from (("endpoint", m.start(), m.end()) for m in _HOST.finditer(text))
        if "://" in text:
            yield from (("endpoint", m.start(), m.end()) for m in _URL.finditer(text))
    for m in _TOKEN.finditer(text):
        if all(c.search(m[0]) for c in _MIXED):
            yield "key", m.start(), m.end()


def parts_of(text: str) -> list[tuple[int, int, int, int]]:
    """(kind, start, end, block) of all base spans and of the weak parts beside
    them: a weak part that overlaps a base span, or a weak part of an earlier
    start, is left out. Without an identifier or a secret nothing can link, so
    weak parts are then left out too."""
    base = base_spans(text)
    weak = sorted(weak_spans(text), key=lambda x: (x[1], -x[2], KINDS.index(x[0])))
    held = {k for k, _, _ in base} | {k for k, _, _ in weak}
    if not (held & {"access", "id"} and held & {"assign", "hex", "key"}):
        weak = []
    found = sorted(base, key=lambda x: (x[1], KINDS.index(x[0])))
    if weak:
        taken, end, kept = sorted((s, e) for _, s, e in base), -1, []
        i = 0
        for kind, s, e in weak:
            while i < len(taken) and taken[i][1] <= s:
                i += 1
            if s >= end and not (i < len(taken) and taken[i][0] < e):
                kept.append((kind, s, e))
                end = e
        found = sorted(found + kept, key=lambda x: (x[1], KINDS.index(x[0])))
    if not found:
        return []
    blanks = [m.start() for m in _BLANK.finditer(text)] if weak else []
    out, block = [], 0
    for kind, s, e in found:
        while block < len(blanks) and blanks[block] < s:
            block += 1
        out.append((KINDS.index(kind), s, e, block))
    return out


# ---- the operator -----------------------------------------------------------

_SPAN = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("block", T.LongType())])


def with_parts(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with an array of (kind, start, end, block), by start and kind."""
    (name,) = fresh(docs, "parts")
    arrow = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("block", pa.int64())]))

    def compute(batch):
        texts = batch.column(batch.schema.get_field_index("text"))
        return pa.array(([dict(zip(("kind", "start", "end", "block"), p)) for p in parts_of(t.as_py())] for t in texts), arrow)

    return with_computed(docs, text_or_empty(text), compute, T.ArrayType(_SPAN), name), name


def _role(kind: Column) -> Column:
    """0 identifier, 1 secret, 2 endpoint."""
    of = {"access": 0, "id": 0, "assign": 1, "hex": 1, "key": 1, "endpoint": 2}
    return F.array(*(F.lit(of[k]) for k in KINDS))[kind]


def _cells(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(F.floor(start / REACH), F.floor((end - 1) / REACH)))


def linked(parts: DataFrame) -> DataFrame:
    """(row, kind, start, end, block) of the weak parts whose scope holds their
    complements, from rows (row, kind, start, end, block) of all parts."""
    p = parts.withColumn("role", _role(F.col("kind")))
    cells = (
        p.filter("role < 2").withColumn("cell", _cells(F.col("start"), F.col("end")))
        .groupBy("row", "block", "cell", "role").agg(F.min("start").alias("first"), F.max("end").alias("last"))
    )
    a, b = F.greatest(F.col("start") - REACH, F.lit(0)), F.col("end") + REACH
    # a part that ends where the scope begins lies in the cell before
    scopes = p.filter(F.col("kind") >= len(BASE)).withColumns({"a": a, "b": b}).withColumn("cell", _cells(F.greatest(F.col("a") - 1, F.lit(0)), F.col("b") + 1))
    met = scopes.withColumnRenamed("role", "own").join(cells, ["row", "block", "cell"])
    # touching counts: at most REACH code points lie between
    met = met.filter((F.col("role") != F.col("own")) & (F.col("first") <= F.col("b")) & (F.col("last") >= F.col("a")))
    roles = met.groupBy("row", "kind", "start", "end", "block").agg(F.countDistinct("role").alias("n"), F.first("own").alias("own"))
    return roles.filter((F.col("n") == 2) | (F.col("own") < 2)).drop("n", "own")


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, base, spans) for every row: arrays of (kind, start, end, block) with
    kinds as numbers into ``KINDS``; ``spans`` adds the linked weak parts."""
    found, name = with_parts(docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")), text)
    table = materialize(found.select(F.col(f"`{key}`").alias("key"), F.col(name).alias("parts"), F.monotonically_increasing_id().alias("row")), "secret-parts")
    weak = F.exists("parts", lambda p: p["kind"] >= len(BASE))
    parts = table.filter(weak).select("row", F.inline("parts"))
    more = linked(parts).groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end", "block")).alias("more"))  # of one text
    base = F.filter("parts", lambda p: p["kind"] < len(BASE))
    every = F.array_sort(
        F.concat(base, F.coalesce("more", F.array().cast(T.ArrayType(_SPAN)))),
        lambda x, y: F.when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1)).otherwise(x["kind"] - y["kind"]),
    )
    rows = table.join(more, "row", "left")
    return rows.select(F.col("key").alias(key), base.alias("base"), F.when(F.col("more").isNull(), base).otherwise(every).alias("spans"))


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")
