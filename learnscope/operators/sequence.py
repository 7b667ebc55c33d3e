"""Skew-safe ordered-sequence primitives: previous/next row and running sums
per key, without putting a whole key into one window partition.

A plain ``lag(x) over (partition by student order by ts)`` sends every row of
a student to one task; one student holding a third of the data would stall
the job. Here each key's timeline is cut into time buckets:

1. window per (key, bucket) gives the in-bucket neighbour / running sum;
2. a per-(key, bucket) summary (one row per active bucket, built with a
   map-side partial aggregate) is windowed per key to get the last row of the
   previous bucket / first row of the next bucket / the bucket's offset;
3. the summary is joined back on (key, bucket).

The summary has at most one row per (key, active bucket), so its per-key
window stays small even for a hot key, and the big table is only ever
partitioned by (key, bucket). Rows with a null order time sort last, in their
own bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BUCKET_SECONDS = 3600
NULL_BUCKET = 9223372036854775807
BUCKET = "__bucket"


def bucket_of(df: DataFrame, ts: str, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> Column:
    """Monotone time bucket of ``ts`` (null times go to a last bucket)."""
    dtype = df.schema[ts].dataType
    if isinstance(dtype, T.TimestampNTZType):
        secs = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts))
    elif isinstance(dtype, T.TimestampType):
        secs = F.unix_micros(F.col(ts)) / F.lit(1_000_000)
    elif isinstance(dtype, T.DateType):
        secs = F.datediff(F.col(ts), F.lit("1970-01-01").cast("date")) * F.lit(86400)
    else:  # numeric order column
        secs = F.col(ts)
    return F.coalesce(F.floor(secs / F.lit(bucket_seconds)).cast("long"), F.lit(NULL_BUCKET))


def _order(ts: str, tie: Sequence[str]) -> list[Column]:
    return [F.col(ts).asc_nulls_last()] + [F.col(t).asc_nulls_last() for t in tie]


def _with_bucket(df: DataFrame, ts: str, bucket_seconds: int) -> DataFrame:
    if BUCKET in df.columns:
        return df
    return df.withColumn(BUCKET, bucket_of(df, ts, bucket_seconds))


def _join_summary(df: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Null-safe equi join of the per-(key, bucket) summary back to rows."""
    ren = summary
    for k in [*keys, BUCKET]:
        ren = ren.withColumnRenamed(k, f"__s_{k}")
    cond = [df[k].eqNullSafe(ren[f"__s_{k}"]) for k in [*keys, BUCKET]]
    out = df.join(ren, on=cond, how="left")
    return out.drop(*[f"__s_{k}" for k in [*keys, BUCKET]])


def with_neighbors(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: Sequence[str],
    values: Sequence[str],
    prev: bool = True,
    nxt: bool = False,
    prefix_prev: str = "prev_",
    prefix_next: str = "next_",
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
    keep_bucket: bool = True,
) -> DataFrame:
    """Add ``prev_<v>`` / ``next_<v>`` (the row before/after in ``(ts, tie)``
    order within ``keys``) for every ``v`` in ``values``; null at the ends.

    ``tie`` must make the order unique within a key."""
    keys, tie, values = list(keys), list(tie), list(values)
    d = _with_bucket(df, ts, bucket_seconds)
    w = Window.partitionBy(*keys, BUCKET).orderBy(*_order(ts, tie))
    payload = F.struct(*[F.col(v).alias(v) for v in values])
    sort_key = [F.col(ts).alias("__t")] + [F.col(t).alias(f"__k{i}") for i, t in enumerate(tie)]
    if prev:
        d = d.withColumn("__lag", F.lag(payload).over(w)).withColumn("__is_first", F.lag(F.lit(1)).over(w).isNull())
    if nxt:
        d = d.withColumn("__lead", F.lead(payload).over(w)).withColumn("__is_last", F.lead(F.lit(1)).over(w).isNull())

    aggs = []
    if prev:
        aggs.append(F.max(F.struct(*sort_key, payload.alias("p"))).alias("__last"))
    if nxt:
        aggs.append(F.min(F.struct(*sort_key, payload.alias("p"))).alias("__first"))
    summary = d.groupBy(*keys, BUCKET).agg(*aggs)
    ws = Window.partitionBy(*keys).orderBy(BUCKET)
    cols = [*keys, BUCKET]
    if prev:
        cols.append(F.lag(F.col("__last.p")).over(ws).alias("__prev_bucket"))
    if nxt:
        cols.append(F.lead(F.col("__first.p")).over(ws).alias("__next_bucket"))
    summary = summary.select(*cols)
    d = _join_summary(d, summary, keys)

    out = []
    for v in values:
        if prev:
            out.append(F.when(F.col("__is_first"), F.col(f"__prev_bucket.{v}")).otherwise(F.col(f"__lag.{v}")).alias(prefix_prev + v))
        if nxt:
            out.append(F.when(F.col("__is_last"), F.col(f"__next_bucket.{v}")).otherwise(F.col(f"__lead.{v}")).alias(prefix_next + v))
    drop = [c for c in ("__lag", "__is_first", "__lead", "__is_last", "__prev_bucket", "__next_bucket") if c in d.columns]
    res = d.select("*", *out).drop(*drop)
    if not keep_bucket:
        res = res.drop(BUCKET)
    return res


def with_running_sum(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: Sequence[str],
    value: Column | str,
    name: str,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
    keep_bucket: bool = True,
) -> DataFrame:
    """Add ``name`` = inclusive running sum of ``value`` in ``(ts, tie)`` order
    within ``keys`` (e.g. a 1-based rank with ``value=1``, or a session index
    with ``value=is_new_session``)."""
    keys, tie = list(keys), list(tie)
    d = _with_bucket(df, ts, bucket_seconds)
    v = F.col(value) if isinstance(value, str) else value
    d = d.withColumn("__v", v.cast("long"))
    w = Window.partitionBy(*keys, BUCKET).orderBy(*_order(ts, tie)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("__cum", F.sum("__v").over(w))
    tot = d.groupBy(*keys, BUCKET).agg(F.sum("__v").alias("__tot"))
    ws = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*keys, BUCKET, F.coalesce(F.sum("__tot").over(ws), F.lit(0)).alias("__off"))
    d = _join_summary(d, tot, keys)
    res = d.withColumn(name, F.col("__off") + F.col("__cum")).drop("__v", "__cum", "__off")
    if not keep_bucket:
        res = res.drop(BUCKET)
    return res


def with_group_index(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: Sequence[str],
    values: Sequence[str],
    starts_group,
    name: str = "group_index",
    flag: str = "is_group_start",
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
    carry: Sequence[str] = (),
    carry_prefix: str = "first_",
    rank: str | None = None,
) -> DataFrame:
    """One-pass skew-safe sessionization: ``name`` = 1-based index of the
    group each row belongs to, where a new group starts at a key's first row
    or wherever ``starts_group(prev, cur)`` is true. ``prev``/``cur`` are
    structs of ``values`` (``prev`` is null at a key's first row). For each
    column ``c`` in ``carry``, ``carry_prefix + c`` is the value of ``c`` on
    the group's first row (carried through the same summary pass). With
    ``rank``, that column is the row's 1-based position within its key.

    Plan: one shuffle of the rows on (keys, bucket) with an in-bucket window
    (lag + running count of starts), a partial aggregate of one summary row per
    (key, bucket) on the same partitioning, a small per-key window over the
    summary (previous bucket's last row, offsets), and a join back."""
    keys, tie, values = list(keys), list(tie), list(values)
    d = _with_bucket(df, ts, bucket_seconds)
    w = Window.partitionBy(*keys, BUCKET).orderBy(*_order(ts, tie))
    cur = F.struct(*[F.col(v).alias(v) for v in values])
    d = d.withColumn("__prev", F.lag(cur).over(w))
    first_in_bucket = F.col("__prev").isNull()
    inner = F.when(first_in_bucket, F.lit(0)).otherwise(F.coalesce(starts_group(F.col("__prev"), cur), F.lit(False)).cast("int"))
    d = d.withColumn("__inner", inner.cast("long"))
    wc = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("__cum", F.sum("__inner").over(wc))
    if rank:
        d = d.withColumn("__rn", F.row_number().over(w))
    carry = list(carry)
    cstruct = F.struct(*[F.col(c).alias(c) for c in carry]) if carry else None
    if carry:  # value at the latest in-bucket (non-first-row) group start
        d = d.withColumn("__cv_in", F.last(F.when(F.col("__inner") == 1, cstruct), ignorenulls=True).over(wc))
    sort_key = [F.col(ts).alias("__t")] + [F.col(t).alias(f"__k{i}") for i, t in enumerate(tie)]
    sort_struct = F.struct(*sort_key)
    aggs = [
        F.min(F.struct(*sort_key, cur.alias("p"))).alias("__first"),
        F.max(F.struct(*sort_key, cur.alias("p"))).alias("__last"),
        F.sum("__inner").alias("__tot"),
        F.count(F.lit(1)).alias("__rows"),
    ]
    if carry:
        aggs += [F.min_by(cstruct, sort_struct).alias("__cfirst"),
                 F.max_by(cstruct, F.when(F.col("__inner") == 1, sort_struct)).alias("__clast")]
    summary = d.groupBy(*keys, BUCKET).agg(*aggs)
    ws = Window.partitionBy(*keys).orderBy(BUCKET)
    prev_last = F.lag(F.col("__last.p")).over(ws)
    extra = ["__cfirst", "__clast"] if carry else []
    summary = summary.select(*keys, BUCKET, "__tot", "__rows", F.col("__first.p").alias("__fp"), prev_last.alias("__pl"), *extra)
    start = F.when(F.col("__pl").isNull(), F.lit(True)).otherwise(F.coalesce(starts_group(F.col("__pl"), F.col("__fp")), F.lit(False)))
    summary = summary.withColumn("__bstart", start.cast("long"))
    wsum = ws.rowsBetween(Window.unboundedPreceding, -1)
    cols = [*keys, BUCKET, "__bstart", F.coalesce(F.sum(F.col("__tot") + F.col("__bstart")).over(wsum), F.lit(0)).alias("__off"),
            F.coalesce(F.sum("__rows").over(wsum), F.lit(0)).alias("__roff")]
    if carry:
        end_carry = F.coalesce(F.col("__clast"), F.when(F.col("__bstart") == 1, F.col("__cfirst")))
        summary = summary.withColumn("__cend", end_carry)
        cols += ["__cfirst", F.last("__cend", ignorenulls=True).over(wsum).alias("__cin")]
    summary = summary.select(*cols)
    d = d.join(summary, on=[*keys, BUCKET], how="inner")
    idx = F.col("__off") + F.col("__bstart") + F.col("__cum")
    is_start = F.when(first_in_bucket, F.col("__bstart") == 1).otherwise(F.col("__inner") == 1)
    d = d.withColumn(name, idx).withColumn(flag, is_start)
    if rank:
        d = d.withColumn(rank, F.col("__roff") + F.col("__rn")).drop("__rn")
    if carry:
        cv = F.coalesce(F.col("__cv_in"), F.when(F.col("__bstart") == 1, F.col("__cfirst")), F.col("__cin"))
        d = d.withColumn("__cv", cv).select("*", *[F.col(f"__cv.{c}").alias(carry_prefix + c) for c in carry])
        d = d.drop("__cv_in", "__cfirst", "__cin", "__cv")
    return d.drop("__prev", "__inner", "__cum", "__bstart", "__off", "__roff")
