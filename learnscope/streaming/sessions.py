"""Incremental sessionization of a turn stream (Structured Streaming).

* :func:`sessionize_stream` — the full rule (entry change OR gap > threshold)
  as a stateful operator: ``groupBy(student).applyInPandasWithState`` keeps
  one small state row per student (last turn time, entry and session index)
  and labels each micro-batch's new turns in (asked_at, turn_id) order. A
  micro-batch is bounded by the source's trigger limits, so even a hot
  student only ever hands one batch to a task. Turns are expected in time
  order per student across batches (turns older than the student's last
  processed turn are labelled with the current session and flagged
  ``late = true``).
* :func:`gap_session_windows` — gap-only sessions with the built-in
  ``session_window`` + watermark (per-session aggregates). A gap of exactly
  the threshold merges, which equals the batch rule's strict ``>``.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions import lexicon as L

STATE_SCHEMA = T.StructType([
    T.StructField("last_at", T.TimestampNTZType()),
    T.StructField("last_entry", T.StringType()),
    T.StructField("last_index", T.IntegerType()),
])


def _labeller(gap_minutes, use_entry, key_cols, idle_ms=None):
    gap_us = None if gap_minutes is None else int(round(gap_minutes * 60_000_000))

    def remember(state, at, entry, index):
        state.update((pd.Timestamp(at).to_pydatetime(), entry, int(index)))
        if idle_ms is not None:
            state.setTimeoutDuration(idle_ms)

    def label(key, batches, state):
        if state.hasTimedOut:
            state.remove()
            return
        pdf = pd.concat(list(batches), ignore_index=True)
        if pdf.empty:
            return
        pdf = pdf.sort_values(["asked_at", "turn_id"], kind="mergesort").reset_index(drop=True)
        t = pdf["asked_at"].astype("datetime64[us]").to_numpy()
        entry = pdf["entry"].fillna("").to_numpy(dtype=object) if use_entry else None
        if state.exists:
            last_at, last_entry, last_index = state.get
            prev_t = np.datetime64(pd.Timestamp(last_at).to_datetime64(), "us")
        else:
            last_at, last_entry, last_index, prev_t = None, None, 0, None
        new = np.zeros(len(pdf), dtype=bool)
        late = np.zeros(len(pdf), dtype=bool)
        if prev_t is None or t[0] >= prev_t:  # in-order batch: vectorized
            prev_all = np.concatenate([[prev_t if prev_t is not None else t[0]], t[:-1]])
            gap = (t - prev_all).astype("int64") > gap_us if gap_us is not None else np.zeros(len(t), dtype=bool)
            if use_entry:
                prev_e = np.concatenate([[last_entry or ""], entry[:-1]]).astype(object)
                gap = gap | (entry != prev_e)
            new = gap
            if prev_t is None:
                new[0] = True
            idx = last_index + np.cumsum(new)
            out = pdf[[*key_cols, "turn_id"]].copy()
            out["session_index"] = idx.astype("int32")
            out["is_new_session"] = new
            out["late"] = late
            remember(state, t[-1], entry[-1] if use_entry else None, idx[-1])
            yield out
            return
        for i in range(len(pdf)):  # a late turn in the batch: sequential fallback
            if prev_t is None:
                new[i] = True
            else:
                late[i] = t[i] < prev_t
                gap = gap_us is not None and (t[i] - prev_t).astype("int64") > gap_us
                changed = use_entry and (entry[i] != (last_entry or ""))
                new[i] = (gap or changed) and not late[i]
            if not late[i]:
                prev_t = t[i]
                last_entry = entry[i] if use_entry else None
        idx = last_index + np.cumsum(new)
        out = pdf[[*key_cols, "turn_id"]].copy()
        out["session_index"] = idx.astype("int32")
        out["is_new_session"] = new
        out["late"] = late
        remember(state, prev_t, last_entry, idx[-1])
        yield out

    return label


def sessionize_stream(turns: DataFrame, gap_minutes: float | None = L.GAP_MINUTES, split_on_entry: bool | None = None,
                      keys=("student_id",), idle_hours: float | None = None) -> DataFrame:
    """Streaming turns -> (keys..., turn_id, session_index, is_new_session,
    late). Same numbering as :func:`operators.segment.segment` for in-order
    input. With ``idle_hours``, a student without turns for that long (processing
    time) is forgotten: the state stays bounded by the active students, and the
    numbering of one who comes back starts again at 1 (not with the availableNow
    trigger, which waits for such timeouts). Batch input belongs to
    :func:`operators.segment.segment`."""
    if not turns.isStreaming:
        raise ValueError("not a stream: use operators.segment.segment for batch input")
    keys = list(keys)
    use_entry = ("entry" in turns.columns) if split_on_entry is None else split_on_entry
    cols = [*keys, "turn_id", "asked_at"] + (["entry"] if use_entry else [])
    out_schema = turns.select(*keys, "turn_id").schema \
        .add("session_index", T.IntegerType()).add("is_new_session", T.BooleanType()).add("late", T.BooleanType())
    return turns.select(*cols).groupBy(*keys).applyInPandasWithState(
        _labeller(gap_minutes, use_entry, keys, None if idle_hours is None else int(idle_hours * 3_600_000)), out_schema, STATE_SCHEMA, "append",
        GroupStateTimeout.NoTimeout if idle_hours is None else GroupStateTimeout.ProcessingTimeTimeout)


def gap_session_windows(turns: DataFrame, gap_minutes: float = L.GAP_MINUTES, watermark: str = "1 hour", keys=("student_id",)) -> DataFrame:
    """Gap-only sessions per student with ``session_window``: start, end and
    number of turns per session (append mode emits closed sessions)."""
    w = F.session_window(F.col("asked_at").cast("timestamp"), f"{int(gap_minutes * 60)} seconds")
    return (
        turns.withColumn("asked_at", F.col("asked_at").cast("timestamp"))
        .withWatermark("asked_at", watermark)
        .groupBy(*keys, w.alias("session"))
        .agg(F.count(F.lit(1)).alias("qa_turns"), F.min("asked_at").alias("t_min"), F.max("asked_at").alias("t_max"))
    )
