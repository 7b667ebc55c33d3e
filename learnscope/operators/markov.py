"""First-order Markov model of session types per (student, class) sequence.

Each sequence is START, the sessions' states in time order, END. Nothing is
materialized as a list: every session row emits its own outgoing transition
(to the next session, or END) via a skew-safe ``lead``, and the first row of a
sequence also emits START -> state. Counting is one ``groupBy(from, to)``
(map-side combine), so the cost is linear in sessions whatever the sequence
lengths.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lexicon as L
from .common import attach_one_row
from .sequence import BUCKET, with_neighbors

SEQ_KEYS = ("student_id", "class_id")


def states_for(k: int) -> list[str]:
    """State list for K clusters: START, c0..c{K-1}, END."""
    return ["START", *[f"c{i}" for i in range(k)], "END"]


def with_state(clustered: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """SCL16: ``state = 'c' + int(cluster)``; rows without a cluster are
    dropped (the original fails on them; count them with
    :func:`sequence_summary`)."""
    return clustered.filter(F.col(cluster_col).isNotNull()).withColumn(
        "state", F.concat(F.lit("c"), F.col(cluster_col).cast("int").cast("string"))
    )


def transitions(
    clustered: DataFrame,
    keys: Sequence[str] = SEQ_KEYS,
    time_col: str = "dialog_time",
    tie: Sequence[str] = ("event_id",),
    cluster_col: str = "cluster",
) -> DataFrame:
    """WIN5 + SRT2 + SET3: one row per transition (keys..., <tie>, from_state,
    to_state). Order: time ascending, unparsable/null times last, then tie."""
    d = with_state(clustered, cluster_col)
    if dict(d.dtypes)[time_col] == "string":
        d = d.withColumn(time_col, F.try_to_timestamp(F.col(time_col)).cast("timestamp_ntz"))
    n = with_neighbors(d, list(keys), time_col, list(tie), ["state"], prev=True, nxt=True).drop(BUCKET)
    cols = [*keys, *tie]
    # one pass: every row emits its outgoing step, the first row also START
    start = F.when(F.col("prev_state").isNull(), F.struct(F.lit("START").alias("f"), F.col("state").alias("t")))
    step = F.struct(F.col("state").alias("f"), F.coalesce(F.col("next_state"), F.lit("END")).alias("t"))
    pairs = F.filter(F.array(start, step), lambda x: x.isNotNull())
    return n.select(*cols, F.explode(pairs).alias("__tr")).select(
        *cols, F.col("__tr.f").alias("from_state"), F.col("__tr.t").alias("to_state"))


def _grid(spark, states: Sequence[str]) -> DataFrame:
    """The state x state grid, built from the state-list parameter."""
    schema = T.StructType([T.StructField("from_state", T.StringType()), T.StructField("to_state", T.StringType()),
                           T.StructField("from_idx", T.IntegerType()), T.StructField("to_idx", T.IntegerType())])
    rows = [(a, b, i, j) for i, a in enumerate(states) for j, b in enumerate(states)]
    return spark.createDataFrame(rows, schema)


def transition_counts(trans: DataFrame, states: Sequence[str] = tuple(L.STATES)) -> DataFrame:
    """AGG32 + JOIN7: counts on the full state grid (missing pairs -> 0).
    Transitions touching a state outside ``states`` are skipped, not
    bridged."""
    known = trans.filter(F.col("from_state").isin(list(states)) & F.col("to_state").isin(list(states)))
    c = known.groupBy("from_state", "to_state").agg(F.count(F.lit(1)).alias("n"))
    g = _grid(trans.sparkSession, states)
    return g.join(F.broadcast(c), on=["from_state", "to_state"], how="left").select(
        "from_state", "to_state", "from_idx", "to_idx", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))


def transition_probs(counts: DataFrame) -> DataFrame:
    """AGG33: row-normalized probabilities; rows with no outgoing
    transitions (END) stay 0. The window runs over the |states|^2-row grid."""
    w = Window.partitionBy("from_state")
    total = F.sum("n").over(w)
    return counts.withColumn("p", F.when(total > 0, F.col("n") / total).otherwise(F.lit(0.0)))


def matrix_wide(probs: DataFrame, value: str = "p", states: Sequence[str] = tuple(L.STATES), labels: Mapping[str, str] = L.STATE_LABELS) -> DataFrame:
    """SNK7 + SCL17: wide matrix, one row per from-state (with its display
    label), one column per to-state, in state order."""
    lab = F.create_map(*[x for s in states for x in (F.lit(s), F.lit(labels.get(s, s)))])
    wide = probs.groupBy("from_state", "from_idx").pivot("to_state", list(states)).agg(F.first(value))
    return wide.withColumn("from_label", lab[F.col("from_state")])


def annotate(probs: DataFrame) -> DataFrame:
    """SCL18: cell text ``'%.2f\\n(%d)' % (p, n)`` with Python's exact
    rounding of the binary double (Spark's ``format_string`` rounds 0.125 up).
    A vectorized pandas UDF over the |states|^2 cells."""
    from ..functions.formatting import prob_count_label

    return probs.withColumn("annotation", prob_count_label(F.col("p"), F.col("n")))


def sequence_summary(clustered: DataFrame, trans: DataFrame, keys: Sequence[str] = SEQ_KEYS, cluster_col: str = "cluster",
                     states: Sequence[str] = tuple(L.STATES)) -> DataFrame:
    """AGG31 + AGG34 + SET2: distinct (student, class) pairs, non-empty
    sequences, rows, rows without a cluster, and skipped transitions."""
    pairs = clustered.select(*keys).distinct().agg(F.count(F.lit(1)).alias("n_pairs"))
    seqs = clustered.filter(F.col(cluster_col).isNotNull()).select(*keys).distinct().agg(F.count(F.lit(1)).alias("n_sequences"))
    rows = clustered.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(cluster_col).isNull()).alias("n_null_cluster"))
    skipped = trans.agg(F.count_if(~(F.col("from_state").isin(list(states)) & F.col("to_state").isin(list(states)))).alias("n_skipped"),
                        F.count(F.lit(1)).alias("n_transitions"))
    # each side is an ungrouped aggregate (exactly one row)
    return attach_one_row(attach_one_row(attach_one_row(pairs, seqs), rows), skipped)
