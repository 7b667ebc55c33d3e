"""Token counts by an exact length histogram.

Every whole text is encoded once; documents are aggregated by their encoded
length (inside the task first, then with one small shuffle). Suffix sums over
the histogram then answer, for every context limit at once, how many documents
and tokens lie above it, the total after truncation, and any quantile.

Defined cases: a null or empty text has length 0 and counts as a document; an
empty table gives an empty histogram; repeated rows count each; strings that
look like special tokens are ordinary text. Only the text column is read, so
other columns, whatever their names, do not matter.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import text_or_empty

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# FIXED VALUE: the public pattern that splits text before the merges of this vocabulary
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BUCKET = 1024  # lengths per bucket of the two-level suffix sums
_encoders: dict = {}


def rank_file_encoder(spark: SparkSession, path: str = TOKENIZER) -> Callable[[Sequence[str]], list[int]]:
    """Lengths under the byte-pair vocabulary of a rank file. The file (about
    1 MB, whatever the data) is read by the driver and broadcast."""
    with open(path, "rb") as f:
        data = spark.sparkContext.broadcast(f.read())

    def lengths(texts: Sequence[str]) -> list[int]:
        if path not in _encoders:
            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.value.splitlines())}
            _encoders[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        encode = _encoders[path].encode_ordinary
        return [len(encode(t)) for t in texts]

    return lengths


def length_histogram(df: DataFrame, lengths: Callable[[Sequence[str]], list[int]], text: str = "text") -> DataFrame:
    """(length, n_docs): how many documents have each encoded length."""

    def count(batches):
        for b in batches:
            c = Counter()
            for i in range(0, b.num_rows, 1000):
                c.update(lengths(b.column(0).slice(i, 1000).to_pylist()))
            yield pa.record_batch([np.fromiter(c.keys(), np.int64, len(c)), np.fromiter(c.values(), np.int64, len(c))], names=["length", "n"])

    parts = df.select(text_or_empty(text).alias("text")).mapInArrow(count, "length long, n long")
    return parts.groupBy("length").agg(F.sum("n").alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """For every length that occurs, taken as a context limit: ``docs_from`` and
    ``tokens_from`` (documents at least that long, and their tokens),
    ``truncated_tokens`` (all tokens that are left when every document is cut
    to the limit), the totals, and ``quantile`` (share of documents not longer).

    Sums run inside buckets of lengths and over the buckets' totals, so that no
    task holds the whole histogram."""
    h = hist.withColumns({"tokens": F.col("length") * F.col("n_docs"), "bucket": F.floor(F.col("length") / BUCKET)})
    per = h.groupBy("bucket").agg(F.sum("n_docs").alias("bd"), F.sum("tokens").alias("bt"))
    # buckets are at most (longest text / BUCKET): a few thousand rows even for texts of millions of tokens
    after = W.orderBy(F.desc("bucket")).rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy()
    per = per.select(
        "bucket",
        F.coalesce(F.sum("bd").over(after), F.lit(0)).alias("bd"),
        F.coalesce(F.sum("bt").over(after), F.lit(0)).alias("bt"),
        F.sum("bd").over(every).alias("total_docs"),
        F.sum("bt").over(every).alias("total_tokens"),
    )
    inside = W.partitionBy("bucket").orderBy(F.desc("length")).rowsBetween(W.unboundedPreceding, 0)
    h = h.withColumns({"docs_from": F.sum("n_docs").over(inside), "tokens_from": F.sum("tokens").over(inside)}).join(per, "bucket")
    docs, tokens = F.col("docs_from") + F.col("bd"), F.col("tokens_from") + F.col("bt")
    return h.select(
        "length",
        "n_docs",
        "tokens",
        docs.alias("docs_from"),
        tokens.alias("tokens_from"),
        (F.col("total_tokens") - tokens + F.col("length") * docs).alias("truncated_tokens"),
        "total_docs",
        "total_tokens",
        ((F.col("total_docs") - docs + F.col("n_docs")) / F.col("total_docs")).alias("quantile"),
    )


def at_limits(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """Totals for any context limits, also such as no document has as length:
    documents and tokens over the limit, tokens left after cutting, tokens lost."""
    spark = sums.sparkSession
    lim = F.broadcast(spark.createDataFrame([(int(x),) for x in limits], "context long"))
    # the first length at or above the limit has the suffix sums of the limit itself
    j = lim.join(sums, F.col("length") >= F.col("context"), "left").groupBy("context").agg(
        F.min_by(F.struct("docs_from", "tokens_from", "total_tokens"), "length").alias("s")
    )
    total = sums.agg(F.max("total_tokens").alias("t"))
    j = j.crossJoin(F.broadcast(total))  # one row
    docs, tokens = F.coalesce("s.docs_from", F.lit(0)), F.coalesce("s.tokens_from", F.lit(0))
    kept = F.coalesce("t", F.lit(0)) - tokens + F.col("context") * docs
    return j.select("context", docs.alias("docs_at_least"), kept.alias("kept_tokens"), (F.coalesce("t", F.lit(0)) - kept).alias("lost_tokens"))


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """The smallest length that at least the given share of documents does not exceed."""
    want = F.broadcast(sums.sparkSession.createDataFrame([(float(x),) for x in shares], "share double"))
    return want.join(sums, F.col("quantile") >= F.col("share"), "left").groupBy("share").agg(F.min("length").alias("length"))
