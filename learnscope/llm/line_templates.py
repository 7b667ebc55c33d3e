"""Line dedup by a log-template tree of fixed depth.

A line (between ``\\n``) goes down the tree by its number of tokens and its first
``DEPTH`` tokens; tokens with a digit are variable fields (``<*>``). In a leaf,
a position whose most frequent token holds at least half of the leaf's weight is
constant, any other is variable; that gives the leaf's template. A line whose
share of tokens equal to the template's constants is at least ``SIMILAR``
belongs to the template. The other lines of the leaf are judged again without
those, by the majority among themselves. Where no line fits, the leaf is cut in
groups by the tokens at one position: the one whose tokens are the most
concentrated (greatest sum of squared weights) of those that vary and have a token of
``MIN_DOCS`` or more; rarer tokens of that position stay together. So a leaf has
as many templates as its lines need. A line that shares too few tokens
with others of its group to fit any template of ``MIN_DOCS`` lines, or whose group
cannot be cut, is a template of its own. A template found in ``MIN_DOCS`` or more documents is recurring: its lines are dropped from
every document but the one with the smallest key.

Work: one pass over the texts counts leaves (summed in the task first), a
bitmap of fixed size marks leaves found in enough documents, and a second pass
emits only lines of marked leaves. Everything that is shuffled by line or leaf is
a count, a hash, or a marked line; frequent lines are collapsed per piece of a
batch. The
texts themselves move once, to meet the numbers of the lines to drop.

Defined cases: a null text has no lines and stays null; an empty text is one
empty line; lines with fewer than ``MIN_TOKENS`` tokens are never dropped;
repeated lines of one document count it once; rows that repeat a key are one
document for the counts, and each loses the same lines; a row with a null key
takes no part and keeps its lines; a document may lose all
its lines and is then an empty text; ties between tokens go to the greater
token; an empty table gives an empty result. All other columns pass through;
only the operator's own added names replace equal ones.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, long_column, materialize, text_or_empty

DEPTH, SIMILAR, MIN_DOCS, MIN_TOKENS = 3, 0.7, 5, 3
BITS = 24  # the bitmap of leaves has 2**BITS bits (2 MB)
FIELD = b"<*>"
_DIGITS = bytes.maketrans(b"0123456789", b"0000000000")


def masked(tokens: list[bytes]) -> list[bytes]:
    return [FIELD if b"0" in t.translate(_DIGITS) else t for t in tokens]


def leaf_of(tokens: list[bytes]) -> int:
    """Number of the leaf that a line's tokens lead to."""
    path = b"%d %s" % (len(tokens), b" ".join(masked(tokens[:DEPTH])))
    return int.from_bytes(hashlib.blake2b(path, digest_size=8).digest(), "little", signed=True)


def lines_of(text: bytes):
    """(number, tokens) of the lines that are long enough to be judged."""
    for i, line in enumerate(text.split(b"\n")):
        tokens = line.split()
        if len(tokens) >= MIN_TOKENS:
            yield i, tokens


def pieces(batches, rows: int = 2000):
    """Arrow batches in pieces of a few rows, so that a task holds the lines of
    a few documents at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def marked_leaves(rows: DataFrame) -> np.ndarray:
    """Bitmap of the leaves that lines of MIN_DOCS or more rows lead to."""

    def count(batches):
        for b in pieces(batches):
            n: dict[int, int] = {}
            for t in b.column(1).cast(pa.binary()):
                for x in {leaf_of(tokens) for _, tokens in lines_of(t.as_py())}:
                    n[x] = n.get(x, 0) + 1
            yield pa.record_batch([np.fromiter(n.keys(), np.int64, len(n)), np.fromiter(n.values(), np.int64, len(n))], names=["leaf", "n"])

    leaves = rows.mapInArrow(count, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_DOCS)
    bit = F.shiftrightunsigned("leaf", 64 - BITS)
    words = leaves.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned(leaf, {64 - BITS}) & 63 as int)))").alias("bits"))
    bitmap = np.zeros(1 << (BITS - 6), np.int64)
    for r in words.collect():  # at most 2**(BITS - 6) rows, whatever the data
        bitmap[r["word"]] = r["bits"]
    return bitmap


def occurrences(rows: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """Lines of marked leaves, one row per batch and distinct masked line:
    (leaf, line, tokens joined by one space, and where it occurs)."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        bits = shared.value
        for b in pieces(batches):
            keys = long_column(b, "doc")
            found: dict[bytes, tuple[int, list, list]] = {}
            for k, t in zip(keys, b.column(1).cast(pa.binary())):
                for i, tokens in lines_of(t.as_py()):
                    leaf = leaf_of(tokens)
                    at = (leaf & (1 << 64) - 1) >> (64 - BITS)
                    if int(bits[at >> 6]) >> (at & 63) & 1:
                        _, docs, numbers = found.setdefault(b" ".join(masked(tokens)), (leaf, [], []))
                        docs.append(k)
                        numbers.append(i)
            yield pa.record_batch(
                [
                    pa.array([x[0] for x in found.values()], pa.int64()),
                    pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in found], pa.binary()),
                    pa.array(list(found), pa.binary()).cast(pa.string()),
                    pa.array([x[1] for x in found.values()], pa.list_(pa.int64())),
                    pa.array([x[2] for x in found.values()], pa.list_(pa.int32())),
                ],
                names=["leaf", "line", "tokens", "docs", "numbers"],
            )

    return rows.mapInArrow(run, "leaf long, line binary, tokens string, docs array<long>, numbers array<int>")


def line_templates(found: DataFrame) -> DataFrame:
    """(line, template): the template that each distinct line belongs to, as
    text. Weights are occurrences."""
    lines = found.groupBy("leaf", "line").agg(F.first("tokens").alias("tokens"), F.sum(F.size("docs")).alias("n"))
    lines = materialize(lines.withColumn("tokens", F.split("tokens", " ")), "lines")
    rest, of = lines.withColumnRenamed("leaf", "grp"), None
    while of is None or not rest.isEmpty():
        fitting, rest = one_round(rest)
        of = fitting if of is None else of.unionAll(fitting)
    # single spaces inside; the count of tokens is part of the leaf, and so of the text
    return lines.join(of, "line", "left").select("line", F.coalesce("template", F.array_join("tokens", " ")).alias("template"))


def weights(lines: DataFrame) -> DataFrame:
    """(grp, pos, token, n): occurrences of every token at every position."""
    at = lines.select("grp", "n", F.posexplode("tokens").alias("pos", "token"))
    return at.groupBy("grp", "pos", "token").agg(F.sum("n").alias("n"))


def one_round(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(line, template) of the lines (grp, line, tokens, n) that fit their
    group's template, and the others that may fit one of a smaller group, with
    their next group."""
    top = weights(lines).groupBy("grp", "pos").agg(F.max(F.struct("n", "token")).alias("top"), F.sum("n").alias("n"), F.sum(F.col("n").cast("double") * F.col("n")).alias("square"))
    top = top.withColumn("c", F.when(2 * F.col("top.n") >= F.col("n"), F.col("top.token")).otherwise(F.lit(FIELD.decode())))
    cut = F.when((F.col("top.n") >= MIN_DOCS) & (F.col("top.n") < F.col("n")), F.struct("square", (-F.col("pos")).alias("pos")))
    # one entry per position of a line: bounded by the longest line of the group
    trees = top.groupBy("grp").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "c"))), lambda x: x["c"]).alias("template"),
        F.max("n").alias("weight"),
        (-F.max(cut)["pos"]).alias("cut"),
    ).filter(F.col("weight") >= MIN_DOCS)
    both = lines.join(trees.drop("weight"), "grp")
    same = F.size(F.filter(F.zip_with("tokens", "template", lambda a, b: a == b), lambda x: x))
    fits = same >= SIMILAR * F.size("tokens")
    judged = materialize(both.withColumn("fits", fits).withColumn("template", F.when(fits, F.array_join("template", " "))), "judged-lines")
    others = judged.filter(~F.col("fits")).select("grp", "line", "tokens", "n", "cut")

    # a constant has half of a group's weight, MIN_DOCS or more: lines with too few tokens of that weight are done
    some = weights(others).filter(2 * F.col("n") >= MIN_DOCS).select("grp", "pos", "token", F.col("n").alias("w"))
    at = others.select("grp", "line", F.size("tokens").alias("size"), "cut", F.posexplode("tokens").alias("pos", "token")).join(some, ["grp", "pos", "token"])
    open_ = at.groupBy("grp", "line").agg(
        F.count(F.lit(1)).alias("shared"), F.first("size").alias("size"), F.max(F.when((F.col("pos") == F.col("cut")) & (F.col("w") >= MIN_DOCS), F.col("token"))).alias("branch")
    ).filter(F.col("shared") >= SIMILAR * F.col("size")).select("line", "branch")
    # a group that lost lines is judged again as it is; one that did not is cut, or is done
    lost = judged.filter("fits").select("grp").distinct().withColumn("lost", F.lit(True))
    next_ = others.join(open_, "line").join(lost, "grp", "left").filter(F.col("lost") | F.col("cut").isNotNull())
    group = F.when(F.col("lost"), F.col("grp")).otherwise(F.xxhash64("grp", "cut", F.coalesce("branch", F.lit("")), F.col("branch").isNull()))
    return judged.filter("fits").select("line", "template"), materialize(next_.select(group.alias("grp"), "line", "tokens", "n"), "open-lines")


def recurring(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(templates, drops): the recurring templates (template, n_docs, first_doc)
    and the line numbers that each document loses (doc, numbers)."""
    rows = docs.select(F.col(key).cast("long").alias("doc"), text_or_empty(text).alias("text")).filter("doc is not null")
    found = materialize(occurrences(rows, marked_leaves(rows)), "line-occurrences")
    # joined as found, one row per piece and line: a frequent line is not one row per occurrence until its template is known
    at = found.select("line", "docs", "numbers").join(line_templates(found), "line")
    at = materialize(at.select(F.md5("template").alias("t"), "template", "docs", "numbers"), "line-templates")
    seen = at.select("t", F.explode("docs").alias("doc")).distinct()
    counts = seen.groupBy("t").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc").alias("first_doc")).filter(F.col("n_docs") >= MIN_DOCS)
    texts = at.groupBy("t").agg(F.first("template").alias("template"))
    templates = materialize(counts.join(texts, "t").select("t", "template", "n_docs", "first_doc"), "templates")
    drop = at.select("t", "docs", "numbers").join(templates.select("t", "first_doc"), "t")
    drop = drop.select("first_doc", F.explode(F.arrays_zip("docs", "numbers")).alias("o")).select("first_doc", F.col("o.docs").alias("doc"), F.col("o.numbers").alias("number"))
    drop = drop.filter("doc != first_doc")
    # a document's own line numbers: bounded by its text
    return templates, drop.groupBy("doc").agg(F.collect_set("number").alias("numbers"))


def drop_recurring(docs: DataFrame, key: str = "doc_id", text: str = "text", counts: tuple[str, str] = ("_n_lines", "_n_removed")) -> DataFrame:
    """``docs`` with recurring lines removed from the text, and the two
    ``counts``: lines of each text, and how many went."""
    _, drops = recurring(docs, key, text)
    doc, drop, lines = fresh(docs, "_doc", "_drop", "_lines")
    drops = materialize(drops.select(F.col("doc").alias(doc), F.col("numbers").alias(drop)), "line-drops")
    # the numbers are the small side of each partition, whatever their total; texts are not sorted
    out = docs.join(drops.hint("shuffle_hash"), F.col(key).cast("long") == F.col(doc), "left").drop(doc)
    out = out.withColumn(lines, F.split(F.col(text), "\n", -1))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(drop))
    new = F.array_join(F.transform(kept, lambda i: F.get(F.col(lines), i)), "\n")
    return out.withColumns(
        {
            text: F.when(F.col(drop).isNull(), F.col(text)).otherwise(new),
            counts[0]: F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("long"),
            counts[1]: F.coalesce(F.size(drop), F.lit(0)).cast("long"),
        }
    ).drop(lines, drop)
